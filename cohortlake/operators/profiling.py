"""Profiles of tables and texts, and comparisons of id sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType


def duplicate_excess(df: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """Rows, distinct keys and rows in excess of them (a null counts as a key)."""
    per_key = df.groupBy(*(by or []), key).count()
    return per_key.groupBy(*(by or [])).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.count("*").alias("keys")).withColumn("excess", F.col("rows") - F.col("keys"))


def duplicated_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).where("n > 1")


def source_masks(sources: dict[str, DataFrame]) -> DataFrame:
    """id, mask: every id of the named sources once, with a bit for each source that holds it, the first source's lowest; ids of all sources meet in one shuffle."""
    tagged = reduce(DataFrame.unionByName, [df.select(F.col(df.columns[0]).cast("string").alias("id"), F.lit(1 << k).cast("long").alias("mask")) for k, df in enumerate(sources.values())])
    return tagged.where("id IS NOT NULL").groupBy("id").agg(F.bit_or("mask").alias("mask"))


def id_set(masks: DataFrame, names: list[str], expression: str) -> DataFrame:
    """The ids for which an expression over the sources' names holds, as `a AND b AND NOT c`."""
    held = masks.select("id", *[(F.col("mask").bitwiseAND(F.lit(1 << k).cast("long")) != 0).alias(name) for k, name in enumerate(names)])
    return held.where(expression).select("id")


def compare_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """left_source, right_source, only_left, only_right, both for each pair of named id sets: the few masks that occur are counted, and pairs added up from them."""
    names = sorted(sources)
    counts = source_masks({k: sources[k] for k in names}).groupBy("mask").count()
    pairs = [(a, b) for a in range(len(names)) for b in range(a + 1, len(names))]
    has = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k).cast("long")) != 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0))
    rows = [
        F.struct(F.lit(names[a]).alias("left_source"), F.lit(names[b]).alias("right_source"), total(has(a) & ~has(b)).alias("only_left"), total(~has(a) & has(b)).alias("only_right"), total(has(a) & has(b)).alias("both"))
        for a, b in pairs
    ]
    return counts.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def differing_ids(sources: dict[str, DataFrame]) -> DataFrame:
    """left_source, right_source, side, id: for each pair of named id sets the ids that only one of the two holds, as rows."""
    names = sorted(sources)
    bit = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k).cast("long")) != 0
    pairs = [F.struct(F.lit(names[a]).alias("left_source"), F.lit(names[b]).alias("right_source"), bit(a).alias("l"), bit(b).alias("r")) for a in range(len(names)) for b in range(a + 1, len(names))]
    rows = source_masks({k: sources[k] for k in names}).select("id", F.inline(F.array(*pairs))).where("l <> r")
    return rows.select("left_source", "right_source", F.when(F.col("l"), "left").otherwise("right").alias("side"), "id")


def summarize_source(df: DataFrame, key: str) -> DataFrame:
    """One row: records, missing (without an id), ids, repeated (ids that occur more than once) and excess (their further records)."""
    per_id = df.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
    known = F.col("id").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0))
    return per_id.agg(
        zero(F.sum("n")).alias("records"), zero(F.sum(F.when(~known, F.col("n")))).alias("missing"), F.count_if(known).alias("ids"),
        F.count_if(known & (F.col("n") > 1)).alias("repeated"), zero(F.sum(F.when(known, F.col("n") - 1))).alias("excess"),
    )


def nest_hierarchy(df: DataFrame, parent: list[str], child: list[str], position: str) -> DataFrame:
    """The parent columns and children: an array of child structs in first-seen order."""
    firsts = df.groupBy(*parent, *child).agg(F.min(position).alias("_at"))
    return firsts.groupBy(*parent).agg(F.array_sort(F.collect_list(F.struct("_at", *child))).alias("_all")).select(*parent, F.transform("_all", lambda x: F.struct(*[x[c].alias(c) for c in child])).alias("children"))


def measure_text(text: Column, characters_per_token: float = 4.0) -> dict[str, Column]:
    """characters, lines and estimated tokens (half-even) of a text; line ends are those of Unicode."""
    ends = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"
    body = F.regexp_replace(text, rf"(?:{ends})\z", "")
    return {
        "characters": F.length(text).cast("long"),
        "lines": F.when(F.length(text) == 0, 0).otherwise(F.size(F.split(body, ends))).cast("long"),
        "tokens": F.bround(F.length(text) / characters_per_token).cast("long"),
    }


def is_binary(content: Column) -> Column:
    """A NUL in the first 8 KiB, or bytes that are not UTF-8."""
    return (F.position(F.lit(b"\x00"), F.substring(content, 1, 8192)) > 0) | ~F.is_valid_utf8(content.cast("string"))


def rollup_by_depth(df: DataFrame, path: str, depth: int, totals: list[str]) -> DataFrame:
    """group, files and the totals by the first path components; shallow paths under their parent, the root under a dot, depth 0 in one row."""
    parts = F.split(path, "/")
    folders = F.slice(parts, 1, F.greatest(F.lit(0), F.least(F.size(parts) - 1, F.lit(depth))))
    group = F.lit(".") if depth == 0 else F.when(F.size(folders) == 0, ".").otherwise(F.array_join(folders, "/"))
    return df.groupBy(group.alias("group")).agg(F.count("*").alias("files"), *[F.sum(c).alias(c) for c in totals])


def heaviest(df: DataFrame, by: str, n: int, ties: list[str]) -> DataFrame:
    """The n heaviest rows, a report."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def first_values(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """For each column its first value that is not null, in the order of a column."""
    return df.agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def run_totals(df: DataFrame, status: str, year: str, size: str, moved: str) -> DataFrame:
    """Rows, first and last year, and the bytes of moved items, for each status."""
    return df.groupBy(F.col(status).alias("status")).agg(
        F.count("*").alias("n"), F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.sum(F.when(F.col(status) == moved, F.col(size)).otherwise(0)).alias("moved_size")
    )


def schema_signatures(lines: DataFrame, shard: str, text: str) -> DataFrame:
    """signature, shards, n: shards whose JSON lines have the same inferred schema."""
    return _signatures(lines, shard, text).groupBy("signature").agg(F.array_sort(F.collect_list("shard")).alias("shards"), F.count("*").alias("n"))


def _signatures(lines: DataFrame, shard: str, text: str) -> DataFrame:
    return lines.groupBy(F.col(shard).alias("shard")).agg(F.expr(f"schema_of_variant_agg(try_parse_json({text}))").alias("signature"))


def paths_of(signature: str) -> dict[str, str]:
    """The paths of a variant's schema, as OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: STRING>>>, with their types; elements of arrays are [*]."""
    found: dict[str, str] = {}

    def walk(kind: str, path: str) -> None:
        head, _, inner = kind.partition("<")
        found[path or "$"] = head
        if not inner:
            return
        inner = inner[:-1]
        if head == "ARRAY":
            walk(inner, f"{path}[*]")
        elif head == "OBJECT":
            for field in _fields(inner):
                name, _, own = _name_and_type(field)
                walk(own, f"{path}.{name}" if path else name)
        else:
            found[path or "$"] = kind

    walk(signature, "")
    return found


def _fields(text: str) -> list[str]:
    """Cut at commas outside brackets and back quotes."""
    out, depth, quoted, begin = [], 0, False, 0
    for i, c in enumerate(text):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and not depth:
                out.append(text[begin:i].strip())
                begin = i + 1
    return [*out, text[begin:].strip()] if text.strip() else []


def _name_and_type(field: str) -> tuple[str, str, str]:
    if field.startswith("`"):
        end = field.index("`: ", 1)
        return field[1:end].replace("``", "`"), ": ", field[end + 3 :]
    return field.partition(": ")


def schema_drift(lines: DataFrame, shard: str, text: str) -> DataFrame:
    """shard, path, change (added, removed, retyped), expected, found: how the inferred schemas of shards differ from the commonest one.

    Of schemas that are equally common the first in the order of their texts is expected. A
    shard whose lines have no schema (none parses) lost all paths.
    """
    own = _signatures(lines, shard, text).withColumn("signature", F.coalesce("signature", F.lit("VOID")))
    paths = F.udf(paths_of, "map<string,string>")
    kinds = own.groupBy("signature").count().withColumn("paths", paths("signature"))  # one call for each schema that occurs
    usual = kinds.orderBy(F.desc("count"), "signature").limit(1).select(F.col("signature").alias("usual"), F.col("paths").alias("wanted"))
    pairs = kinds.crossJoin(F.broadcast(usual)).where("signature <> usual")
    each = pairs.select("signature", "wanted", "paths", F.explode(F.array_distinct(F.concat(F.map_keys("wanted"), F.map_keys("paths")))).alias("path"))
    each = each.select("signature", "path", F.try_element_at("wanted", F.col("path")).alias("expected"), F.try_element_at("paths", F.col("path")).alias("found"))
    changes = each.where("NOT expected <=> found").withColumn("change", F.expr("CASE WHEN expected IS NULL THEN 'added' WHEN found IS NULL THEN 'removed' ELSE 'retyped' END"))
    return own.join(changes, "signature").select("shard", "path", "change", "expected", "found")


def _canonical(value: Column) -> Column:
    """A text of a JSON value that does not depend on the order of its keys; null for JSON's null."""
    return F.nullif(F.to_json(value), F.lit("null"))


def json_fidelity(df: DataFrame, source: str, stored: str) -> DataFrame:
    """n, parsed (the stored text parses), same (it equals the source's value, whatever the order of keys)."""
    value = lambda c: F.to_json(F.try_parse_json(c))
    return df.agg(F.count("*").alias("n"), F.count_if(F.try_parse_json(stored).isNotNull()).alias("parsed"), F.count_if(value(source).eqNullSafe(value(stored))).alias("same"))


def landed_fidelity(lines: DataFrame, text: str, stored: DataFrame, key: str, columns: list[str], most: int = 1_000_000) -> DataFrame:
    """json_column, ids, values, parsed, same: landed lines against the stored records of the same id, for each column that keeps JSON text.

    values are the stored texts that are not null, parsed those that parse; same counts the ids
    whose stored values are the landed ones, as many times each and whatever the order of keys.
    Of keys that a line repeats the last counts, as when pages are read. The session's number of
    partitions holds as long as about `most` rows of both sides meet in one; more would spill.
    """
    # Only the values that are asked for become variants; a line that is no object, or is broken anywhere, counts for nothing.
    broken = "_broken line"
    schema = StructType([StructField(c, VariantType()) for c in dict.fromkeys([key, *columns])] + [StructField(broken, StringType())])
    line = F.from_json(F.when(F.ltrim(F.col(text), F.lit(" \t")).startswith("{"), F.col(text)), schema, {"columnNameOfCorruptRecord": broken})
    found = lines.select(line.alias("line")).where(F.col("line")[broken].isNull())
    left = found.select(
        F.try_variant_get(F.col("line")[key], "$", "string").alias("id"), F.lit(True).alias("landed"), *[F.coalesce(F.to_json(F.col("line")[c]), F.lit("null")).alias(f"v_{c}") for c in columns], *[F.lit(False).alias(f"n_{c}") for c in columns]
    )
    own = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), F.when(F.col(c).isNull(), "null").otherwise("broken"))
    right = stored.select(F.col(key).alias("id"), F.lit(False).alias("landed"), *[own(c).alias(f"v_{c}") for c in columns], *[F.col(c).isNotNull().alias(f"n_{c}") for c in columns])
    # Both sides meet in one shuffle; of most ids there is one row of each.
    met = left.unionByName(right).where("id IS NOT NULL")
    parts = -(-2 * stored.count() // most)  # of Parquet the footers say it
    if parts > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        met = met.repartition(parts, "id")
    both = met.groupBy("id").agg(
        F.collect_list(F.struct("landed", *[f"v_{c}" for c in columns])).alias("all"), F.count_if("landed").alias("lines"),
        *[F.count_if(f"n_{c}").alias(f"n_{c}") for c in columns], *[F.count_if(F.col(f"n_{c}") & (F.col(f"v_{c}") != "broken")).alias(f"p_{c}") for c in columns],
    )
    side = lambda c, landed: F.array_sort(F.transform(F.filter("all", lambda x: x["landed"] == landed), lambda x: x[f"v_{c}"]))
    value = lambda c, i: F.get("all", F.lit(i))[f"v_{c}"]
    same = lambda c: F.when((F.size("all") == 2) & (F.col("lines") == 1), value(c, 0) == value(c, 1)).when(F.size("all") == 2 * F.col("lines"), side(c, True) == side(c, False))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rows = [
        F.struct(F.lit(c).alias("json_column"), F.count("*").alias("ids"), zero(f"n_{c}").alias("values"), zero(f"p_{c}").alias("parsed"), F.count_if(same(c)).alias("same")) for c in columns
    ]
    return both.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def drop_missing_ids(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and a row with the number of those without."""
    return df.where(F.col(key).isNotNull()), df.agg(F.count_if(F.col(key).isNull()).alias("dropped"))
