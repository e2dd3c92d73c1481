import collections
import zlib

import corpus_pipeline
import duckdb
import pytest
import xxhash

from cohortlake.llm import jaccard_join, queries
from cohortlake.llm.common import materialize
from test_text_operators import components, contaminated


def test_stages_keep_the_columns_and_shrink(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").withColumnRenamed("n_chars", "n_chars")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, data), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert packed.select("doc_id").distinct().count() == before


def test_copies_and_contamination_by_brute_force_on_each_own_input(spark, data):
    """Exactly one document of each group of near copies stays, and exactly the documents without benchmark passages."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert len({i for i, _ in texts}) == len(texts)
    kept = materialize(stages["near_copies"](spark, docs, data), "kept")
    ids = {r.doc_id for r in kept.collect()}
    sizes = collections.Counter()
    for i, component in components(texts, 5, 80).items():
        sizes[component] += i in ids
    assert set(sizes.values()) == {1} and len(ids) < len(texts)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    dirty = {x[0] for x in contaminated([x for x in texts if x[0] in ids], items) if x[-1]}
    clean = {r.doc_id for r in stages["decontamination"](spark, kept, data).collect()}
    assert dirty and clean == ids - dirty


@pytest.mark.parametrize("name", ["toxicity", "near_copies", "decontamination"])
def test_stages_start_no_workers_beside_those_of_sql_and_send_them_little_at_once(spark, data, name, monkeypatch):
    """An RDD of Python objects has a daemon and workers of its own in each executor, which stay there beside those of SQL functions."""

    def refused(*_, **__):
        raise AssertionError("rows of Python become an RDD")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert 0 < dict(corpus_pipeline.STAGES)[name](spark, docs, data).count() <= docs.count()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"


def test_a_worker_remembers_few_words_and_hashes_all_alike():
    words = [f"word{i}".encode() for i in range(60_000)]
    known, most = jaccard_join.WordHashes(), 0
    for word in words:
        assert known[word] == xxhash.xxh64_intdigest(word)
        most = max(most, len(known))
    assert most == jaccard_join.REMEMBERED_WORDS == 25_000


def test_one_query_for_each_operator():
    assert [int(x[2:].split("_")[0]) for x in queries.QUERIES if x.startswith("op")] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = sorted(c[0] for c in cursor.description)
    found = queries.QUERIES[name](spark, data)
    assert sorted(found.columns) == names
    at = [[c[0] for c in cursor.description].index(n) for n in names]
    assert sorted(repr(tuple(r[c] for c in names)) for r in found.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in cursor.fetchall())


def test_toxicity_quality_and_packing_by_other_ways_on_each_own_input(spark, data):
    """The toxicity stage drops the rows that op4 predicts, the quality stage those that the SQL of op3 does not keep, and packing loses no id of what is left."""
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    predicted = {r.doc_id for r in queries.op4_toxicity(spark, data).collect() if r.predicted == 0}
    clean = materialize(stages["toxicity"](spark, docs, data), "clean")
    assert {r.doc_id for r in clean.collect()} == predicted
    con = duckdb.connect()
    con.register("documents", clean.toArrow())
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLE_SQL['op3_quality_rules']}) WHERE kept").fetchall()}
    good = materialize(stages["quality"](spark, clean, data), "good")
    assert {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < len(predicted)
    pieces = collections.defaultdict(list)
    for r in stages["packing"](spark, good, data).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    library = Tokenizer.from_file(queries.vocabulary())
    for r in good.collect():
        ids, at = [*library.encode(r.text, add_special_tokens=False).ids, 1], 0
        for start, length, crc in sorted(pieces[r.doc_id]):
            assert start == at and crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + length]))
            at += length
        assert at == len(ids)
