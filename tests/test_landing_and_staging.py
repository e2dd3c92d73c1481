"""Landing zones, bronze, manifests and staging."""

import gzip
import json
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortlake import standin
from cohortlake.operators import profiling, staging
from cohortlake.operators.works import silver_works
from cohortlake.plans import manifests, quality, queries
from cohortlake.schemas import BRONZE, WORKS, differences
from cohortlake.sources import landing, tables
from tests.test_aggregates import BOUNDS

RECORD = {
    "id": "W1", "title": "t", "publication_year": 2021, "publication_date": "2021-03-01", "type": "article", "language": "en", "is_retracted": False, "is_paratext": False,
    "primary_topic": {"id": "T1", "display_name": "d", "score": "0.5", "subfield": {"id": "s/1702", "display_name": "AI"}, "field": {"id": "f"}}, "topics": [{"id": "T1", "subfield": {"id": "s"}}, None],
    "cited_by_count": 3, "counts_by_year": [{"year": "2021", "cited_by_count": 2}, {"year": "x", "cited_by_count": 1}], "cited_by_percentile_year": {"min": 1, "max": "2.5"}, "citation_normalized_percentile": {"value": 0.5, "is_in_top_1_percent": "yes", "is_in_top_10_percent": True},
    "fwci": 1.5, "referenced_works_count": 1, "open_access": {"is_oa": True, "oa_status": "gold"}, "doi": "d", "ids": {"doi": "x"}, "keywords": [], "updated_date": "2024-06-01T10:00:00.123456",
}


def land(root, year, pages, report=True, fetched=None, query=None, meta=False):
    folder = root / str(year)
    folder.mkdir(parents=True)
    for i, page in enumerate(pages, 1):
        (folder / f"page-{i:04d}.jsonl").write_text("".join(x if isinstance(x, str) else json.dumps({**RECORD, "publication_year": year, **x}) + "\n" for x in page))
    if meta:
        (folder / "_META.json").write_text("{}")
    if report:
        n = sum(map(len, pages)) if fetched is None else fetched
        (folder / "_YEAR_REPORT.json").write_text(json.dumps({"query": query or f"filter=publication_year:{year},x", "year": year, "started_at": "a", "completed_at": "b", "expected_count": n + 1, "records_fetched": n, "page_count": len(pages), "count_mismatch": True}, indent=1))


def states(spark, root, years=(2018, 2025), done=()):
    done = spark.createDataFrame([(y,) for y in done], "publication_year BIGINT")
    return landing.shard_states(landing.landing_inventory(spark, str(root)), landing.year_axis(spark, *years), done)


def test_states(spark, tmp_path):
    land(tmp_path, 2018, [[{}], [{}]])
    land(tmp_path, 2019, [[{}]], report=False)
    land(tmp_path, 2020, [])
    land(tmp_path, 2021, [[]])
    land(tmp_path, 2022, [[], [{}]])
    land(tmp_path, 2023, [], report=False, meta=True)
    land(tmp_path, 2024, [[{}]])
    found = {r.publication_year: (r.landing, r.bronze) for r in states(spark, tmp_path, done=[2024]).collect()}
    assert found == {
        2018: ("COMPLETE", "READY"), 2019: ("IN_PROGRESS", "PENDING"), 2020: ("COMPLETE", "CORRUPT"), 2021: ("COMPLETE", "EMPTY"), 2022: ("COMPLETE", "CORRUPT"),
        2023: ("IN_PROGRESS", "PENDING"), 2024: ("COMPLETE", "INGESTED"), 2025: ("FRESH", "PENDING"),
    }
    assert {r[0] for r in landing.discover_years(landing.landing_inventory(spark, str(tmp_path))).collect()} == set(range(2018, 2025))
    assert landing.year_axis(spark, 3, 2).isEmpty()


def test_ingest_and_manifest(spark, tmp_path):
    root, base = tmp_path / "in", str(tmp_path / "bronze")
    land(root, 2020, [[{"id": i} for i in ("W1", "W1", "W1")], [{"id": i} for i in ("W2", "W2", "W3")]])
    land(root, 2021, [[{"id": "W9", "ids": {"doi": " spaced",  "n": 1}}]])
    land(root, 2019, [[]])
    assert manifests.ingest(spark, str(root), base, states(spark, root)) == 3
    bronze = tables.read_bronze(spark, base)
    assert differences(bronze.select(*BRONZE.fieldNames()).schema, BRONZE) == []
    assert bronze.where("id = 'W9'").first().ids == '{"doi": " spaced", "n": 1}'
    manifest = manifests.bronze_manifest(states(spark, root, (2020, 2022), [2020, 2021]), landing.read_reports(spark, str(root)), bronze, landing.landing_inventory(spark, base))
    rows = {r.publication_year: r for r in manifest.collect()}
    assert (rows[2020].status, rows[2020].bronze_row_count, rows[2020].duplicate_id_count) == ("INGESTED", 6, 3)
    done = {r[0] for r in landing.ingested_years(landing.landing_inventory(spark, base)).collect()}
    assert done == {2019, 2020, 2021} and {r.publication_year: r.bronze for r in states(spark, root, (2019, 2020), done).collect()} == {2019: "INGESTED", 2020: "INGESTED"}
    assert bronze.where("publication_year = 2019").count() == 0 and spark.read.parquet(f"{base}/publication_year=2019").columns == [c for c in BRONZE.fieldNames() if c != "publication_year"]
    assert rows[2022].status == "PENDING" and rows[2021].ingested_at is not None and rows[2021].bronze_file_path.endswith("publication_year=2021")
    assert manifests.manifest_mismatches(manifest).isEmpty()
    spark.catalog.clearCache()
    land(root, 2022, [[{"id": "W5"}]])
    assert manifests.ingest(spark, str(root), base, states(spark, root, done=[2019, 2020, 2021])) == 1
    assert tables.read_bronze(spark, base).count() == 8
    assert landing.query_homogeneity(landing.read_reports(spark, str(root))).count() == 1
    land(root, 2023, [[{}]], query="filter=publication_year:2023,other")
    assert landing.query_homogeneity(landing.read_reports(spark, str(root))).count() == 2


def test_an_empty_year_must_have_fetched_nothing(spark, tmp_path):
    land(tmp_path / "in", 2019, [[]], fetched=2)
    with pytest.raises(manifests.IntegrityError):
        manifests.ingest(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), states(spark, tmp_path / "in"))
    assert not (tmp_path / "bronze").exists()


@pytest.mark.parametrize("page", [[{"id": None}], ["{broken\n"], [{"cited_by_count": "three"}], [{}, {}, {}]])
def test_bad_shards_write_nothing(spark, tmp_path, page):
    root, base = tmp_path / "in", tmp_path / "bronze"
    land(root, 2020, [page], fetched=1)
    with pytest.raises(Exception):  # noqa: B017
        manifests.ingest(spark, str(root), str(base), states(spark, root))
    assert not base.exists()


def test_a_bad_shard_leaves_the_years_that_are_there(spark, tmp_path):
    root, base = tmp_path / "in", tmp_path / "bronze"
    land(root, 2020, [[{}]])
    assert manifests.ingest(spark, str(root), str(base), states(spark, root)) == 1
    land(root, 2021, [[{}, {}]], fetched=3)
    land(root, 2022, [[{}]])
    with pytest.raises(manifests.IntegrityError, match="2021"):
        manifests.ingest(spark, str(root), str(base), states(spark, root, done=[2020]))
    assert sorted(x.name for x in tmp_path.iterdir()) == ["bronze", "in"] and [x.name for x in base.iterdir()] == ["publication_year=2020"]


def test_folders_are_partitions_of_the_inventory(spark, tmp_path):
    for year in range(2000, 2012):
        land(tmp_path, year, [[{}], []], meta=True)
    (tmp_path / "loose.txt").write_text("not in a folder")
    found = landing.landing_inventory(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 12 and found.count() == 48
    blank = {(r.folder, r.name): r.length for r in found.where("length = 0").collect()}
    assert len(blank) == 12 and set(blank.values()) == {0}
    assert landing.landing_inventory(spark, str(tmp_path / "missing")).isEmpty() and landing.read_reports(spark, str(tmp_path / "missing")).isEmpty()
    (tmp_path / "2000" / landing.REPORT_NAME).write_text("{broken")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landing.read_reports(spark, str(tmp_path)).collect()


def test_pages_are_written_where_their_lines_are(spark, tmp_path):
    rows = spark.range(0, 900, 1, 2).selectExpr("concat('W', id) AS id", "'é\\n' || id AS title", "nullif(id % 301, 300) AS publication_year")
    root = f"file://{tmp_path}/landing"
    before = len(list(tmp_path.iterdir()))
    zone = queries.LandingZone(spark, root)
    zone.write(rows)
    found = landing.read_pages(spark, [f"{root}/*/page-*.jsonl"])
    assert sorted(map(tuple, found.select("id", "title", "publication_year").collect())) == sorted(map(tuple, rows.where("publication_year IS NOT NULL").collect()))
    assert {r.year: r.records_fetched for r in landing.read_reports(spark, root).collect()} == {r.publication_year: r["count"] for r in rows.groupBy("publication_year").count().collect() if r.publication_year is not None}
    # Two tasks write all years from where the rows are: at most a page of each year in each.
    assert before == 0 and zone.inventory().where("name LIKE 'page%'").groupBy("folder").count().agg({"count": "max"}).first()[0] <= 2
    assert not [x for x in (tmp_path / "landing").iterdir() if x.is_file()]


def test_versions_of_records_share_the_counts_of_line_items(spark, data):
    rows = standin.bronze(spark, data)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem.parquet") + plan.count("Aggregate [l_orderkey") <= 2 and "Union" not in plan
    assert rows.where("title = 'a'").count() == rows.where("title <> 'a' AND CAST(substring(id, 2) AS BIGINT) % 5 < 2").count() > 0


def test_records_of_another_year_than_their_folder_are_counted_by_folder(spark, tmp_path):
    root, base = f"{tmp_path}/landing", f"{tmp_path}/bronze"
    zone = queries.LandingZone(spark, f"file://{root}")
    rows = spark.range(6).selectExpr("concat('W', id) AS id", "2000 + id % 2 AS publication_year")
    zone.write(rows)
    page = next((tmp_path / "landing" / "2000").glob("page-*"))
    page.write_text(page.read_text().replace('"publication_year":2000', '"publication_year":2001'))
    states = landing.shard_states(zone.inventory(), landing.discover_years(zone.inventory()), rows.limit(0).select("publication_year"))
    manifests.ingest(spark, f"file://{root}", f"file://{base}", states)
    assert tables.read_bronze(spark, f"file://{base}").where("publication_year = 2001").count() > 3


def test_gzipped_pages_hold_the_same_lines_on_less_disk(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 2).selectExpr("concat('W', id) AS id", "'é\\n' || id AS title", "2000 + id % 3 AS publication_year")
    zones = {packed: queries.LandingZone(spark, f"file://{tmp_path}/{packed}", packed) for packed in (False, True)}
    for zone in zones.values():
        zone.write(rows)
    lines = {packed: sorted(map(tuple, landing.read_lines(spark, zone.root).select("value", "folder").collect())) for packed, zone in zones.items()}
    assert lines[True] == lines[False] and len(lines[True]) == 6000
    pages = sorted((tmp_path / "True").glob("*/page-*"))
    assert len(pages) == 6 and all(p.name.endswith(".jsonl.gz") for p in pages) and gzip.decompress(pages[0].read_bytes()).count(b"\n") == 1000
    found = {packed: {r.publication_year: r for r in states(spark, zone.root, (2000, 2002)).collect()} for packed, zone in zones.items()}
    assert all((r.bronze, r.pages) == ("READY", 2) and 4 * r.bytes < found[False][y].bytes for y, r in found[True].items())
    bronze = {}
    for packed, zone in zones.items():
        assert manifests.ingest(spark, zone.root, f"file://{tmp_path}/b{packed}", states(spark, zone.root, (2000, 2002))) == 3
        bronze[packed] = sorted(map(tuple, tables.read_bronze(spark, f"file://{tmp_path}/b{packed}").select("id", "title", "publication_year").collect()))
    assert bronze[True] == bronze[False] == sorted(map(tuple, rows.collect()))


def test_a_cut_gzipped_page_writes_nothing_and_a_blank_one_is_an_empty_year(spark, tmp_path):
    root, base = tmp_path / "in", tmp_path / "bronze"
    land(root, 2020, [[{}, {}]])
    whole = gzip.compress((root / "2020" / "page-0001.jsonl").read_bytes() * 500)
    (root / "2020" / "page-0002.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):  # noqa: B017
        manifests.ingest(spark, str(root), str(base), states(spark, root))
    assert not base.exists()
    (root / "2020" / "page-0002.jsonl.gz").write_bytes(gzip.compress(b""))
    land(root, 2021, [], fetched=0)
    (root / "2021" / "page-0001.jsonl.gz").write_bytes(gzip.compress(b""))
    assert manifests.ingest(spark, str(root), str(base), states(spark, root)) == 2
    assert {r[0] for r in landing.ingested_years(landing.landing_inventory(spark, str(base))).collect()} == {2020, 2021} and tables.read_bronze(spark, str(base)).count() == 2


def test_a_page_ends_at_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "MOST_IN_PAGE", 1000)
    rows = spark.range(0, 30_000, 1, 1).selectExpr("concat('W', id) AS id", "2000 + id % 2 AS publication_year")
    zone = queries.LandingZone(spark, f"file://{tmp_path}/landing", packed=True)
    zone.write(rows)
    report = {r.year: (r.records_fetched, r.page_count) for r in landing.read_reports(spark, zone.root).collect()}
    assert report == {y: (15_000, len(list((tmp_path / "landing" / str(y)).glob("page-*")))) for y in (2000, 2001)} and min(n for _, n in report.values()) > 1
    assert landing.read_pages(spark, [f"{zone.root}/*/{landing.PAGES}"]).select("id").distinct().count() == 30_000


def test_a_page_of_a_store_is_gzipped_once(tmp_path, monkeypatch):
    from pyarrow import array, fs, large_binary

    monkeypatch.setattr(fs, "FileSystem", type("Store", (), {"from_uri": staticmethod(lambda uri: (fs.LocalFileSystem(), str(tmp_path / uri.partition("://")[2])))}))
    page = queries.Page("store://2020/page-1.jsonl.gz")
    page.add(array([b"one\n", b"two\n"], large_binary()))
    page.close()
    assert (page.lines, page.bytes) == (2, 8) and gzip.decompress((tmp_path / "2020" / "page-1.jsonl.gz").read_bytes()) == b"one\ntwo\n"


def test_years_are_ingested_in_portions(spark, tmp_path, monkeypatch):
    assert manifests.portions([(1, 3), (2, 3), (3, 9), (4, 0), (5, 6), (6, 1)], 6) == [[1, 2], [3], [4, 5], [6]] and manifests.portions([], 6) == []
    monkeypatch.setattr(manifests, "MOST_AT_ONCE", 1)
    root, base = tmp_path / "in", str(tmp_path / "bronze")
    for year in (2020, 2021, 2022):
        land(root, year, [[{"id": f"W{year}"}, {"id": f"V{year}", "publication_year": 2022}]])
    assert manifests.ingest(spark, str(root), base, states(spark, root)) == 3
    found = sorted(map(tuple, tables.read_bronze(spark, base).select("publication_year", "id").collect()))
    assert found == [(2020, "W2020"), (2021, "W2021"), (2022, "V2020"), (2022, "V2021"), (2022, "V2022"), (2022, "W2022")]  # no portion replaces the record of another
    land(root, 2023, [[{}]])
    land(root, 2024, [[{}]], fetched=2)
    with pytest.raises(manifests.IntegrityError, match="2024"):
        manifests.ingest(spark, str(root), base, states(spark, root, done=[2020, 2021, 2022]))
    assert len(list(Path(base).glob("publication_year=*"))) == 3 and len(list(tmp_path.iterdir())) == 2


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for folder in folders for p in Path(folder).rglob("shuffle_*")}


def test_landing_and_ingest_leave_no_shuffles(spark, tmp_path):
    before = _shuffle_files(spark)
    zone = queries.LandingZone(spark, f"file://{tmp_path}/landing")
    zone.write(spark.range(2000).selectExpr("concat('W', id) AS id", "2000 + id % 2 AS publication_year").repartition(3, "id"))
    tables.write_bronze(landing.read_pages(spark, [f"{zone.root}/*/page-*.jsonl"]), f"file://{tmp_path}/bronze")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_landed_fidelity_keeps_its_landing_small(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "scratch", lambda spark, name: f"file://{tmp_path}/{name}")
    queries.landed_fidelity(spark, data)
    root = tmp_path / "landing"
    lines = landing.read_lines(spark, f"file://{root}").agg(F.count("*"), F.sum(F.octet_length("value") + 1)).first()
    pages = list(root.glob("*/page-*"))
    assert lines[0] == spark.read.parquet(f"{data}/orders.parquet").count() and 5 * sum(p.stat().st_size for p in pages) < lines[1]


def test_a_year_of_one_subfield_is_dealt_to_several_sorted_files(spark, tmp_path):
    rows = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit(2020).cast("long").alias("publication_year"), F.lit("s/1").alias("primary_topic_subfield_id")).repartition(8)
    few = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit(2021).cast("long").alias("publication_year"), (F.col("id") % 5).cast("string").alias("primary_topic_subfield_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        tables.write_works(rows.unionByName(few), str(tmp_path / "w"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "w" / "publication_year=2020").glob("part-*"))) > 3
    for file in (tmp_path / "w" / "publication_year=2021").glob("part-*"):
        own = [r[0] for r in spark.read.parquet(str(file)).select("primary_topic_subfield_id").collect()]
        assert own == sorted(own)
    assert spark.read.parquet(str(tmp_path / "w")).count() == 40_040


def bronze_rows(spark, *changes):
    text = lambda r: tuple(json.dumps(v) if isinstance(v, dict | list) else v for v in (r[c] for c in BRONZE.fieldNames()))
    return spark.createDataFrame([text({**RECORD, **c}) for c in changes], BRONZE)


def test_staging(spark):
    df = staging.stage(bronze_rows(
        spark, {}, {"id": "W2", "is_retracted": None}, {"id": "W3", "is_paratext": True}, {"id": "W4", "publication_year": 1900}, {"id": "W5", "counts_by_year": None, "updated_date": "2024-06-01", "publication_date": "2024-06-31"},
        {"id": "W6", "updated_date": "2024-06-01T10:00:00", "title": "old"}, {"id": "W6", "updated_date": "2024-06-01T10:00:00.5", "title": "new"}, {"id": "W6", "updated_date": "never", "title": "a"},
        {"id": "W7", "counts_by_year": {"year": 2020}, "topics": "broken", "primary_topic": None, "ids": None},
    ), BOUNDS)
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {"W1", "W5", "W6", "W7"} and rows["W6"].title == "new"
    one = rows["W1"]
    assert (one.primary_topic_id, one.primary_topic_score, one.primary_topic_subfield_id, one.primary_topic_field_display_name) == ("T1", 0.5, "s/1702", None)
    assert (one.cited_by_percentile_year_min, one.cited_by_percentile_year_max, one.is_in_top_1_percent, one.is_in_top_10_percent, one.is_oa) == (1, None, None, True, True)
    assert [tuple(x) for x in one.counts_by_year] == [(2021, 2), (None, 1)] and [x.id for x in one.topics] == ["T1", None] and one.keywords == []
    assert one.updated_date == datetime(2024, 6, 1, 10, 0, 0, 123456) and str(one.publication_date) == "2021-03-01"
    assert rows["W5"].updated_date is None and rows["W5"].publication_date is None and rows["W5"].counts_by_year == []
    assert rows["W7"].counts_by_year == [] and rows["W7"].topics == [] and rows["W7"].primary_topic_id is None
    silver = silver_works(df, BOUNDS)
    assert differences(silver.schema, WORKS) == [] and {r.id: r.is_ai_strict for r in silver.collect()} == {"W1": True, "W5": True, "W6": True, "W7": False}


def test_year_filter_prunes_partitions(spark, tmp_path):
    tables.write_bronze(bronze_rows(spark, {}, {"id": "W2", "publication_year": 2022}), str(tmp_path / "b"))
    df = staging.stage(tables.read_bronze(spark, str(tmp_path / "b")), replace(BOUNDS, year_min=2022))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(publication_year" in plan and "PushedFilters: [IsNotNull(is_retracted)" in plan
    assert [r.id for r in df.collect()] == ["W2"]


def test_stale_years_and_gaps(spark):
    at = lambda *rows: spark.createDataFrame([(y, datetime(2024, 1, d), True) for y, d in rows], "publication_year BIGINT, modified TIMESTAMP, complete BOOLEAN")
    source, target = at((1, 2), (2, 2), (3, 2), (4, 2)), at((1, 3), (2, 2), (3, 1))
    assert {r[0] for r in manifests.stale_partitions(source, target).collect()} == {3, 4}
    years = spark.range(1, 6).selectExpr("id AS publication_year")
    assert {r[0] for r in manifests.layer_gaps(years, [source, target]).collect()} == {3, 4, 5}
    files = spark.createDataFrame([("/b/publication_year=1/x", 5, datetime(2024, 1, 1)), ("/b/publication_year=1/y", 6, datetime(2024, 1, 2)), ("/b/7.parquet", 1, None)], "path STRING, length BIGINT, modified TIMESTAMP")
    manifest = manifests.upload_manifest(files)
    assert {(r.publication_year, r.file_size_bytes) for r in manifest.collect()} == {(1, 11), (7, 1)}
    assert {tuple(r) for r in manifests.manifest_problems(manifest, spark.range(1, 3).selectExpr("id AS publication_year")).collect()} == {(2, "missing"), (7, "unexpected"), (7, "no_time")}


def test_quality_operators(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", None), (None, "a", 2.0), (None, None, -1.0)], "k INT, v STRING, x DOUBLE")
    assert quality.not_null(df, "k").count() == 2 and quality.unique(df, "k").count() == 1 and quality.unique_combination(df, ["v"]).count() == 1
    assert quality.accepted_values(df, "v", ["a"]).count() == 1 and quality.accepted_range(df, "x", 0, 1).count() == 2 and quality.expression_true(df, "x > 0").count() == 1
    report = quality.report([quality.Check("a", lambda: quality.not_null(df, "k")), quality.Check("b", lambda: quality.not_null(df, "v"), "warn")])
    assert {tuple(r) for r in report.collect()} == {("a", "error", 2), ("b", "warn", 1)} and [r.check_name for r in quality.failed(report).collect()] == ["a"]
    with pytest.raises(tables.ContractError, match="missing"):
        tables.check_contract(df.drop("x"), df.schema)
    assert quality.reconcile(df.where("k = 1"), df.where("v = 'b'"), ["v"], ["x"]).count() == 1


def test_text_measures_and_rollup(spark):
    df = spark.createDataFrame([("one two six.\n",), ("",), ("a\nb",), ("café\n",), ("a\r\nb\r\n\r\n",), ("x" * 10,)], "t STRING")
    found = [tuple(r) for r in df.select(*profiling.measure_text(df["t"]).values()).collect()]
    assert found == [(13, 1, 3), (0, 0, 0), (3, 2, 1), (5, 1, 1), (8, 3, 2), (10, 1, 2)]
    files = spark.createDataFrame([("a/b/c.txt", 1), ("a/d.txt", 2), ("e.txt", 4), ("a/b/f/g.txt", 8)], "p STRING, n BIGINT")
    got = lambda d: {r["group"]: (r["files"], r["n"]) for r in profiling.rollup_by_depth(files, "p", d, ["n"]).collect()}
    assert got(0) == {".": (4, 15)} and got(1) == {"a": (3, 11), ".": (1, 4)} and got(2) == {"a/b": (2, 9), "a": (1, 2), ".": (1, 4)}
    raw = spark.createDataFrame([(b"a\x00b",), (b"\xff\xfe",), ("é".encode(),)], "c BINARY")
    assert [r[0] for r in raw.select(profiling.is_binary(raw["c"])).collect()] == [True, True, False]


def test_id_sources_and_exports(spark, tmp_path):
    (tmp_path / "log").write_text("t - INFO - W1\nt - WARNING - W2 and W3 - W2\nt - ERROR - W4\n")
    (tmp_path / "check.json").write_text('{"completed_work_ids": [\n"W1", "W2"]}')
    log, done = landing.ids_from_log(spark, str(tmp_path / "log")), landing.ids_from_checkpoint(spark, str(tmp_path / "check.json"))
    assert {tuple(r) for r in profiling.compare_sources({"log": log, "done": done}).collect()} == {("done", "log", 1, 2, 1)}
    df = spark.createDataFrame([(1, "http://x/17", None), (2, "http://x/18", "n")], "k INT, id STRING, n STRING")
    tables.write_jsonl(df, ["k", "n"], str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"k":1}', '{"k":2,"n":"n"}']
    tables.export_slice(df, "k = 1", ["k", "id"], str(tmp_path / "csv"), ("id",))
    assert [tuple(r) for r in tables.read_extract(spark, str(tmp_path / "csv"), df.select("k", "id").schema).collect()] == [(1, "17")]


def test_written_steps_need_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, key, default=None):
            return self.held.get(key.removeprefix("spark.").replace(".", "_"), default)

    class Session:
        def __init__(self, **held):
            self.conf = Conf(**held)

    with pytest.raises(ValueError, match="checkpoint"):
        tables.scratch(Session(master="spark://host:7077"), "x")
    assert tables.scratch(Session(master="spark://host:7077", checkpoint_dir="s3://b/steps/"), "x").startswith("s3://b/steps/x-")
    assert tables.scratch(Session(master="local[2]"), "x").startswith("file:///tmp/spark-")
