"""Rules that several operators share: exact ids, cuts of texts, regions, the cascade's order, odd rows in the pipeline's stages."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlake.llm import common, decontaminate, jaccard_join, packing, quality_rules, token_counts, token_files, toxicity
from cohortlake.llm.encoding import Encoder

from test_text_operators import components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BIG = (1 << 60) + 1


def test_long_ids_stay_exact_beside_nulls(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(BIG, text), (BIG + 2, text), (None, text)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(BIG + 5, text)], "item_id long, text string")
    model = toxicity.Model({"one": 9.0}, -1.0)
    found = [
        jaccard_join.jaccard_components(docs), decontaminate.contamination(docs, items), packing.pack(docs, VOCABULARY), token_counts.token_counts(docs, VOCABULARY),
        token_files.round_trip(docs, VOCABULARY), toxicity.offending(docs, model),
    ]
    for df in found:
        assert sorted((r.doc_id for r in df.collect()), key=str) == [BIG, BIG + 2, None]
    assert {r.component_id for r in found[0].collect()} == {BIG, None}


def test_words_are_parted_from_marks_as_the_library_does():
    of = Encoder(public_tokenizers.path("byte_bpe_50k.json"), most=3)
    texts = ["a.", "é.", "a!?", "ab.\n", "x) y", "don't. it's, 'q'", 'a." b.""" c', "ñ;: 5. 5, ª. 漢. 漢", "a..\n.b", "a.  b. ", "ʰ. Ա. é. \u0301.", "word word. word, word.) word", "", None]
    assert of.tails
    for _ in range(2):
        for text in texts:
            assert of.encode([text]) == of.whole([text or ""])
    assert of.encode(texts) == of.whole([x or "" for x in texts])


def test_cuts_give_the_ids_of_the_library():
    rng = random.Random(5)
    parts = ["a", "b ", " ", "  ", "\n", "\t", "<|endoftext|>", "<|endo", "'s", "n't", "é", "1", "23", "!!", "\xa0", "　", "\x1c", "日本", "\r\n", " \n", "#", "word", "\x85", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(8_000)] + [None, "", " ", "   ", "def f():\n        return 1\n\n\n    x  =   2 "]
    of = Encoder(VOCABULARY, most=500)
    for i in range(0, len(texts), 700):
        assert of.encode(texts[i : i + 700]) == of.whole([x or "" for x in texts[i : i + 700]])


@pytest.mark.parametrize("most", [8, 64])
def test_open_regions_are_joined_again(spark, most):
    rng = random.Random(most)
    base = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice([w, w, w, w, w, w, w, w, f"x{rng.randrange(99)}"]) for w in base)) for i in range(150)]
    texts += [(150 + i, " ".join(base[: 30 + i % 4] + [f"y{i}"])) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, 2, 80, pivots=1, most=most).collect()}
    assert found == components(texts, 2, 80)


def test_a_region_of_unlinked_documents_is_cut_and_loses_no_link(spark):
    rng = np.random.default_rng(1)
    sketches = rng.integers(0, 1 << 63, (1_000, jaccard_join.FOLDED), dtype=np.uint64)
    sketches[500:520] = sketches[:20]
    sketches[500:520, 0] ^= np.uint64(7)  # three bits apart
    rows = [(1, i, 40, 0, i, x.tobytes()) for i, x in enumerate(sketches)]
    for near, most in ((rows, 100), ([(1, i, 4000, 0, i, x) for _, i, *_, x in rows], 300)):
        cut = jaccard_join.cut_regions(spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], bytearray(r[5])) for r in near], jaccard_join._REGION), 85, most)
        parts = {}
        for r in cut.select("region", "rep").collect():
            parts.setdefault(r.region, set()).add(r.rep)
        assert max(map(len, parts.values())) <= 1.3 * most  # blocks are dealt by hash
        assert all(any({i, 500 + i} <= p for p in parts.values()) for i in range(20))


def test_the_cascade_takes_rejections_per_cost_of_what_is_left():
    rejects = np.array([[1, 1, 0], [1, 1, 0], [1, 0, 0], [0, 0, 1]], bool)
    assert quality_rules.greedy_order(rejects, np.array([1.0, 1.0, 1.0])) == [0, 2, 1]
    assert quality_rules.greedy_order(rejects, np.array([9.0, 1.0, 2.0])) == [1, 2, 0]
    assert quality_rules.greedy_order(np.zeros((0, 2), bool), np.array([2.0, 1.0])) == [1, 0]


def test_stages_judge_rows_not_ids(spark, data):
    prose = spark.read.parquet(f"{data}/documents.parquet").where("lang = 'en' AND n_chars > 2000").orderBy("doc_id").limit(3).select("text").collect()
    passage = spark.read.parquet(f"{data}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first().text
    a, b, c = (r.text for r in prose)
    rows = [(1, a), (1, a), (None, a), (1, b), (2, passage), (2, c), (None, passage), (3, None), (4, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, n_words long, score double"
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "r", 7, 0.5) for i, t in rows], schema)
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    texts = lambda df: sorted(r.text or "" for r in df.collect())
    once = jaccard_join.keep_one(docs)
    assert once.columns == docs.columns and texts(once) == sorted(["", "", a, b, c, passage])
    clean = decontaminate.remove_contaminated(docs, items)
    assert clean.columns == docs.columns and passage not in texts(clean) and texts(clean).count(c) == 1 and len(texts(clean)) >= 6
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns and "" not in texts(kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in quality_rules.judge(docs).where("kept").collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert common.materialize(stage(spark, docs.limit(0), data), name).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), data).count() == 0
