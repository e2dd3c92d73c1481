"""Operators on documents against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlake.llm import decontaminate, encoding, jaccard_join, packing, quality_rules, queries, token_counts, token_files, toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n long, a string, part string, _words string"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "one two"), (6, "one two"), (7, "a b a b a b a b a b a b"), (8, LONG), (9, LONG + " more"), (10, "ÀB é \U0001f600 <|> ###"),
    (11, "x \n<|endoftext|> y"), (12, "x\n <|endoftext|>  z   z \n  q "), (13, "line\nline\nline\n\nother"), (None, "no id here"), (None, None), (14, " 's it's I'll 12 3,4"),
]


def rows(spark, more=()):
    return spark.createDataFrame([(i, t, 1, "a", "p", "w") for i, t in [*ODD, *more]], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def components(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = words(lower(t))
        sets.setdefault(i, []).append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, documents, width, percent):
    base = [f"b{i}" for i in range(60)]
    near = [(1000 + k, " ".join([*base[:k], f"new{k}", *base[k + 1 :]])) for k in range(0, 60, 3)]
    chain = [(2000 + k, " ".join(f"c{i}" for i in range(2 * k, 2 * k + 70))) for k in range(12)]
    docs = rows(spark, near + chain).unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    found = jaccard_join.jaccard_components(docs, width, percent).collect()
    assert len(found) == docs.count()
    texts = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect() if r[0] is not None]
    wanted = components(texts, width, percent)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == wanted
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert sum(r.n_shingles == 0 for r in found if r.doc_id in (1, 2, 3)) == 3


def test_a_filter_that_empties_every_batch(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"alone {k} and no other document has these words") for k in range(40)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    monkeypatch.setattr(jaccard_join, "LARGE", 0)
    try:
        none = jaccard_join.Among(docs.where("doc_id < 0").select(F.col("doc_id").alias("id")), "id")
        import numpy as np

        keys, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        assert jaccard_join._features(docs, 5, 80, keys, n, none).count() == 0
        pairs = spark.createDataFrame([(1, 2)], "a long, b long")
        assert [r.united > r.common for r in jaccard_join.verified(docs, pairs, 5).collect()] == [True]
        copies = docs.unionByName(docs.select((F.col("doc_id") + 100).alias("doc_id"), "text"))
        assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(copies).collect()} == {k: k % 100 for k in [*range(40), *range(100, 140)]}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_components_in_small_regions_and_one_document_stays(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOTS", 1)
    docs = rows(spark, [(100 + k, " ".join(f"z{i}" for i in range(k, k + 50))) for k in range(25)])
    wanted = components([(r[0], r[1]) for r in docs.select("doc_id", "text").collect() if r[0] is not None], 5, 80)
    found = jaccard_join.jaccard_components(docs, pivots=1)
    assert {r.doc_id: r.component_id for r in found.collect() if r.doc_id is not None} == wanted
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in wanted.items() if i == c} | {None}
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_parity_bits_never_exceed_the_difference():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 2**63, 9000).astype(np.uint64)
    for n, m in ((10, 30), (2000, 3000), (8000, 9000)):
        x, y = np.unique(values[:n]), np.unique(values[n // 2 : m])
        assert jaccard_join.bits_apart(jaccard_join.parities(x), jaccard_join.parities(y)) <= len(np.setxor1d(x, y))


def counts(text):
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


@pytest.mark.parametrize("bits", [21, 3])
def test_statistics_of_quality(spark, documents, monkeypatch, bits):
    monkeypatch.setattr(quality_rules, "_BITS", bits)  # 3 bits: every longer text takes the exact way
    docs = rows(spark).unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    found = quality_rules.judge(docs).collect()
    wanted = collections.Counter((r[0], *counts(r[1])) for r in docs.select("doc_id", "text").collect())
    assert collections.Counter(tuple(r)[:7] for r in found) == wanted
    assert not any(r.kept for r in found if r.base_failed)


def test_quality_keeps_clean_texts_in_any_order_of_rules(spark, documents):
    clean = " ".join(f"word{i}" for i in range(80))
    docs = rows(spark, [(20, clean), (21, clean + " ###" * 30), (22, clean.upper())])
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {20} and not {r.doc_id for r in kept.collect()} & {21, 22, 1, 2, 7, None}
    judged = quality_rules.with_statistics(documents.select("doc_id", "text"))
    both = [{r[0] for r in judged.where(quality_rules.passes(list(order))).select("doc_id").collect()} for order in (quality_rules.RULES, quality_rules.RULES[::-1])]
    assert both[0] == both[1]
    assert quality_rules.judge(empty(spark)).count() == 0


def toxic_corpus(spark):
    rude = ["grumbold", "grumbolding", "vexatron", "vexatrons"]
    texts = [(i, " ".join(f"w{(i * 7 + k) % 91}" for k in range(40)) + ". " + (f"you {rude[i % 4]} there. " if i % 5 == 0 else "you there. ") + "the end") for i in range(600)]
    docs = spark.createDataFrame([(i, t, 1, "a", "p", "w") for i, t in texts], SCHEMA)
    return docs, spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)] + [(None, 1, 1), (9999, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels, F.expr("doc_id % 3 <> 1"))
    scores = {r[0]: r[1] for r in docs.select("doc_id", toxicity.score(model)).collect()}
    held = [i for i in scores if i % 3 == 1]
    assert sum((scores[i] >= 0.7) == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    found = toxicity.offending(docs.where("doc_id < 20"), model).collect()
    assert found and all("grumbold" in r.sentence or "vexatron" in r.sentence for r in found)
    kept = toxicity.reject_toxic(docs, labels, F.expr("doc_id % 3 <> 1"))
    assert kept.columns == docs.columns and 440 <= kept.count() <= 500


def test_long_clean_texts_stay_clean(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels, F.expr("doc_id % 3 <> 1"))
    clean = [r.text for r in docs.where("doc_id % 5 <> 0").collect()]
    rude = docs.where("doc_id = 5").first().text
    for text in (clean[0], clean[1], rude, "you grumbold. nothing else"):
        assert model.document("\n".join([text] * 1000)) == model.document(text)
    joined = "\n".join(clean * 20)
    assert len(joined) > 1_000_000 and model.document(joined) < 0.1
    assert model.document("qzx wvb. " * 10_000) < 0.05 and model.document(joined + "\n" + rude) >= 0.7


def test_fit_is_bounded_in_bytes(spark, monkeypatch):
    docs, labels = toxic_corpus(spark)
    monkeypatch.setattr(toxicity, "MOST_CHARS", 20_000)
    sample = toxicity._training(docs, labels, F.lit(True)).collect()
    for label, all_of in ((0, 480), (1, 120)):
        own = [r for r in sample if r.toxic == label]
        assert 0 < sum(len(r.text) for r in own) <= 20_000 and abs(sum(r.weight for r in own) - all_of) <= 2  # two toxic labels have no document
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.document("you grumbold there.") > model.document("you there.")


def test_query_of_toxicity_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.op4_toxicity(spark, sf).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic IS NOT NULL").collect() if r.doc_id in found}
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in found.items())
    held = [(found[i].score, y) for i, y in truth.items() if found[i].held_out]
    toxic, clean = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert sum((s >= 0.7) == (y == 1) for s, y in held) >= 0.94 * len(held) and sum(s >= 0.7 for s in toxic) >= 0.75 * len(toxic)
    assert sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) >= 0.93 * len(toxic) * len(clean)


def test_toxicity_of_odd_texts_and_without_labels(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels, F.lit(True))
    scores = [(r[0], r[1]) for r in rows(spark).select("doc_id", toxicity.score(model)).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for _, s in scores) and {s for i, s in scores if i in (1, 2, 3)} == {0.0}
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert none.document("anything") == 0.0
    assert toxicity.fit(empty(spark), labels, F.lit(True)).document("x") == 0.0


ITEMS = [(1, " ".join(f"t{i}" for i in range(30))), (2, "Short ITEM"), (3, None), (4, ""), (5, " ".join(f"t{i}" for i in range(10, 25))), (10, "a b a b a b a b a b a b a b"), (1, " ".join(f"t{i}" for i in range(30)))]


def contaminated(texts, items, width=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k : k + width])].add(i)
    for i, t in texts:
        w, hit, found = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= own
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("most", [1 << 20, 200])
def test_contamination(spark, documents, data, most):
    texts = [(30, "pre " + ITEMS[0][1] + " post"), (31, " ".join(f"f{i}" for i in range(400)) + " " + ITEMS[0][1].upper()), (32, "t0 " * 20), (33, "short, item."), (34, "a b " * 30), (35, "t0 t1")]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").union(spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text"))
    docs = rows(spark, texts).unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    found = decontaminate.contamination(docs, benchmark, near_span=26, most=most)
    wanted = collections.Counter(contaminated([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in benchmark.collect()]))
    assert collections.Counter(tuple(r)[:6] for r in found.collect()) == wanted


def test_contamination_of_odd_rows_and_near_matches(spark):
    item = spark.createDataFrame([(1, ITEMS[0][1])], "item_id long, text string")
    shuffled = " ".join(f"t{i}" for i in [1, 0, *range(2, 30)])
    far = " filler".join([""] + [f" t{i}" for i in range(30)])
    found = decontaminate.contamination(rows(spark, [(40, shuffled), (41, far * 3)]), item, near_span=26).collect()
    assert len(found) == len(ODD) + 2
    near = {r.doc_id: r.n_near for r in found}
    assert near[40] == 1 and near[8] == 0
    stay = decontaminate.remove_contaminated(rows(spark, [(42, ITEMS[0][1])]), item)
    assert stay.columns == rows(spark).columns and stay.count() == len(ODD)
    assert decontaminate.contamination(empty(spark), item).count() == 0
    assert {r.n_items for r in decontaminate.contamination(rows(spark), item.limit(0)).collect()} == {0}


@pytest.mark.parametrize("most", [1 << 20, 200])
def test_contamination_of_null_and_repeated_ids(spark, most):
    items = [*ITEMS, (None, " ".join(f"n{i}" for i in range(20)))]
    texts = [(6, ITEMS[0][1]), (6, "clean words"), (None, ITEMS[4][1] + " more"), (None, "f " * 30), (50, items[-1][1]), (None, items[-1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = rows(spark, texts)
    found = decontaminate.contamination(docs, benchmark, most=most).collect()
    wanted = list(contaminated([(i, t) for i, t in [*ODD, *texts]], items[:-1]))
    wanted[-2:] = [(i, 20, 20, 0, hashlib.sha256(b"").hexdigest(), True) for i in (50, None)]
    assert collections.Counter(tuple(r)[:6] for r in found) == collections.Counter(wanted)
    stay = decontaminate.remove_contaminated(docs, benchmark, most=most)
    clean = collections.Counter((i, t) for (i, t), r in zip([*ODD, *texts], wanted, strict=True) if not r[5])
    assert stay.columns == docs.columns and collections.Counter((r.doc_id, r.text) for r in stay.collect()) == clean


def ids_of(texts):
    library = Tokenizer.from_file(VOCABULARY)
    return [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_packing_covers_every_id_once(spark, documents):
    docs = rows(spark).unionByName(documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text"), allowMissingColumns=True)
    found = packing.pack(docs, VOCABULARY, with_ids=True).collect()
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = collections.Counter((i, len(x) + 1, crc([*x, 1])) for (i, _), x in zip(texts, ids_of([t for _, t in texts]), strict=True))
    parts = collections.defaultdict(list)
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        parts[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    for (i, total, check), n in wanted.items():
        if n == 1 and sum(1 for w in wanted if w[:2] == (i, total)) == 1:
            own = sorted(parts[i, total])
            assert zlib.crc32(b"".join(x for _, x in own)) == check
            assert [s for s, _ in own] == [sum(len(x) // 4 for _, x in own[:k]) for k in range(len(own))]
    assert sum(r.length for r in found) == sum(k[1] * n for k, n in wanted.items())
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert sum(r.length for r in found) >= 0.97 * 2048 * len(sequences)
    assert packing.pack(empty(spark), VOCABULARY).count() == 0


def test_known_cuts_are_looked_up_once():
    import public_tokenizers

    class Known(dict):
        """Words that are known must be found by one look each, and not be gathered in a set before."""

        looks = 0

        def get(self, x):
            Known.looks += 1
            return super().get(x)

    of = encoding.Encoder(public_tokenizers.path("byte_bpe_50k.json"), most=50)
    texts = ["the cat sat on the mat, the end.", None, "", " a  b<|endoftext|>  c ", "zürich the mat the mat", "the"] * 2
    assert of.encode(texts) == [x if t else b"" for t, x in zip(texts, of.whole([t or "" for t in texts]), strict=True)]
    of.known, known = Known(of.known), len(of.known)
    assert of.encode(texts[:1]) == of.whole(texts[:1]) and (Known.looks, len(of.known)) == (7, known)
    of.most = 0
    for batch in (texts, texts[::-1], ["quite new words the cat"]):  # generations change after each
        assert of.encode(batch) == [x if t else b"" for t, x in zip(batch, of.whole([t or "" for t in batch]), strict=True)]


def test_packing_groups_of_null_and_repeated_ids_stay_small(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, f"text {i}") for i in range(6000)], "doc_id long, text string")
    found = packing.pack(docs, VOCABULARY).collect()
    groups = collections.Counter(r.sequence_id >> 24 for r in found)
    assert len(found) == 6000 and max(groups.values()) < 2 * packing.GROUP


def test_differencing_is_near_equal_and_raises_the_count():
    sizes = [512] * 9 + [3, 500, 77, 401, 2, 2, 333]
    for count in (2, 3, 5):
        found = packing.difference(sizes, count)
        assert sorted(i for x in found for i in x) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in x) for x in found]
        assert max(sums) - min(sums) <= 512
    assert len(packing.windows_of([1200, 1200, 1200], 2048)) == 3
    assert packing.windows_of([], 2048) == []


@pytest.mark.parametrize("sent", [400_000, 5])
def test_token_counts(spark, documents, monkeypatch, sent):
    monkeypatch.setattr(token_counts, "MOST_SENT", sent)
    monkeypatch.setattr(token_counts, "MOST_GATHERED", 1000)
    docs = rows(spark).unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = collections.Counter((i, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(texts, ids_of([t for _, t in texts]), strict=True))
    assert collections.Counter(map(tuple, token_counts.token_counts(docs, VOCABULARY).collect())) == wanted
    assert token_counts.token_counts(empty(spark), VOCABULARY).count() == 0


def test_token_files_round_trip(spark, documents, monkeypatch):
    docs = rows(spark).unionByName(documents.select("doc_id", "text"), allowMissingColumns=True)
    found = sorted(map(tuple, token_files.round_trip(docs, VOCABULARY).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted((r[0] for r in found), key=lambda i: (i is not None, i))
    assert [r[1] for r in found] == [sum(x[2] for x in found[:k]) for k in range(len(found))]
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = collections.Counter((i, len(x) + 1, crc([*x, 0])) for (i, _), x in zip(texts, ids_of([t for _, t in texts]), strict=True))
    assert collections.Counter((r[0], r[2], r[3]) for r in found) == wanted
    assert token_files.round_trip(empty(spark), VOCABULARY).count() == 0


def test_token_file_frames_and_damage():
    import io

    token_files_writer = token_files.Writer()
    docs = [(i, bytes([i]) * 4 * (i * 1000 + 1)) for i in range(60)]
    parts = [p for i, x in docs for p in token_files_writer.add(i, x)] + list(token_files_writer.end())
    data = b"".join(parts)
    reader = token_files.Reader(io.BytesIO(data))
    assert len(reader.sizes) > 1 and [reader.read(i) for i in range(60)] == [x for _, x in docs]
    assert reader.read(7) == docs[7][1]
    broken = bytearray(data)
    broken[20] ^= 0xFF
    with pytest.raises(Exception):  # noqa: B017
        token_files.Reader(io.BytesIO(bytes(broken))).read(0)
