"""N-gram Jaccard join of documents, as a join in the metric space of shingle sets.

Jaccard distance is a metric. The space is cut in three steps:

1. Pivots of the first level are one-shingle sets {s}. A document x is at
   distance 1 - 1/|x| from each of its own shingles and at distance 1 from the
   others, so its nearest pivots are its shingles; the tie is broken by one
   global order, rare shingles first. A document that is linked to x shares one
   of the first |x| - ceil(t|x|) + 1 shingles of x in that order (the prefix
   bound, by the pigeonhole principle), and x is replicated to their regions.
   The order is learned twice: from a bounded sample, and then from the exact
   sizes of the regions that it gives, whose largest are moved to its end; the
   documents in them choose their regions anew.
2. Inside a region the first documents are pivots, and exact distances to them
   are computed. What is linked to a pivot is settled with it.
3. Regions whose documents lie in several components are joined again, between
   components: in the Hamming space of parity sketches, in which linked
   documents are at most (1 - t) / (1 + t) * (|x| + |y|) apart. A region that is
   too large for one task is cut into Voronoi cells of sketch pivots; x is in the
   cell of its nearest pivot and, by the triangle inequality, is replicated to
   those whose pivot is at most twice the radius farther. Cells that are still
   too large are cut again. A region that no pivot can cut, as its documents are
   all within a radius of each other, is compared in pairs of blocks. Only pairs
   that size, position and sketch allow leave a region; first the nearest of each two
   components, then, when what these link is settled, all that are left.

Document pivots alone cannot cut this space: unrelated documents are all at
distance 1 from each other, so every window would hold every region.

A parity sketch of each document bounds the distance of a pair from below, so
that whole sets are only fetched for pairs that can be linked.

Copies (equal shingle sets) are one point. Links are decided on whole sets of
64-bit shingle hashes, with integers; nothing is capped or sampled. The sample
and the region sizes only set the order, on which no result depends.

Defined results: a document without words or with a null text has no shingles
and is its own component; fewer words than a shingle are one shingle; rows that
repeat a doc_id count as one document with linked texts; rows with a null doc_id
get a null component. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_columns, ids_of, in_chunks, materialize, numbered, remember_only, small_batches

#: Documents from which the order of shingles is learned, and most entries of the order.
SAMPLE_DOCS = 4_000
MOST_COMMON = 200_000
#: Document pivots of a region on the first pass.
PIVOTS = 2
#: Rows that make a region worth another order, and rows that one task compares.
LARGE = 16
MOST_ROWS = 2_048
#: Sketch pivots of a region that is cut, and cuts of cuts.
CELLS = 8
LEVELS = 6
#: Words whose hashes a worker remembers, of about 200 bytes each; most words of a corpus are rare, so that more are hardly faster.
REMEMBERED_WORDS = 25_000
#: Least and most bits of a runtime filter on documents, 8 for each of them; a full one only lets more documents pass.
FILTER_BITS = (1 << 16, 1 << 26)
#: Words of the sketches that are sent to regions.
FOLDED = 8
#: Power of two of the bits of a short document's parity sketch; long ones have 2 to 4 bits a shingle.
LEAST_PARITIES = 11
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    count = max(1, len(words) - width + 1)
    mixed = np.full(count, min(width, len(words)), np.uint64)
    for i in range(min(width, len(words))):
        mixed = (mixed ^ hashes[i : i + count]) * _MIX[i % 5]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def parities(shingles: np.ndarray) -> bytes:
    """For each of a power of two of classes of shingles, whether the set holds an odd number.

    Two sketches differ in at most as many bits as the sets differ in shingles.
    A longer sketch is folded to a shorter one by XOR of its halves.
    """
    classes = 1 << max(LEAST_PARITIES, (2 * len(shingles)).bit_length())
    at = (shingles >> np.uint64(20)).astype(np.int64) & (classes - 1)
    return np.packbits(np.bincount(at, minlength=classes).astype(np.uint8) & 1).tobytes()


def folded(parity: bytes) -> bytes:
    """The sketch of FOLDED 64-bit words."""
    x = np.frombuffer(parity, np.uint64)
    while len(x) > FOLDED:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def prefix_length(size: int, percent: int) -> int:
    return size + percent * size // -100 + 1


def _order(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that three or more of the sampled documents hold, sorted, and estimates of how many of all hold them."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    sample = docs.sample(fraction=share, seed=1) if share < 1 else docs

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_chunks(batches):
            sets = [shingle_set(t, width) for t in batch["text"]]
            yield pd.DataFrame({"s": np.concatenate(sets).view(np.int64)})

    common = sample.select("text").mapInPandas(shingles, "s long").groupBy("s").count().where("count >= 3").orderBy(F.desc("count"), "s").limit(MOST_COMMON).toPandas()
    return _sorted(common["s"], (common["count"] / share).astype(np.int64))


def _sorted(shingles, counts) -> tuple[np.ndarray, np.ndarray]:
    keys = np.asarray(shingles, np.int64).view(np.uint64)
    by = np.argsort(keys)
    return keys[by], np.asarray(counts, np.int64)[by]


class Among:
    """A bit filter on the column `name` of ids; it passes some others too, more when it is full."""

    def __init__(self, ids: DataFrame, name: str):
        least, most = FILTER_BITS
        self.size = min(most, max(least, 1 << (8 * ids.count()).bit_length()))
        slot = F.pmod(F.xxhash64(name), F.lit(self.size))
        words = ids.groupBy((slot / 32).cast("long").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64({name}), {self.size}L), 32) as int))")).alias("bits")).toPandas()
        bits = np.zeros(self.size // 32, np.uint32)
        bits[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
        self.shared = ids.sparkSession.sparkContext.broadcast(bits)

    def slot(self):
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.size)).alias("slot")

    def reader(self):
        """For a function in tasks: the rows of a batch (with its slots) that may be among the ids."""
        shared = self.shared

        def held(batch: pd.DataFrame) -> np.ndarray:
            at = batch["slot"].to_numpy(np.int64)
            return (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1

        return held

    def without(self, rows: DataFrame) -> DataFrame:
        """The rows whose doc_id is not passed."""
        held = self.reader()

        @F.pandas_udf("boolean")
        def passed(slots: pd.Series) -> pd.Series:
            return pd.Series(held(pd.DataFrame({"slot": slots})))

        return rows.where(~passed(self.slot()))


def in_order(shingles: np.ndarray, keys: np.ndarray, counts: np.ndarray, first: int) -> np.ndarray:
    """The first shingles in the global order: by known count, then by hash."""
    if not len(keys):
        return shingles[:first]
    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
    known = keys[at] == shingles
    if not known.any():
        return shingles[:first]
    rare = shingles[~known]
    if len(rare) >= first:
        return rare[:first]
    frequent = shingles[known]
    return np.concatenate([rare, frequent[np.lexsort((frequent, counts[at[known]]))]])[:first]


def _features(docs: DataFrame, width: int, percent: int, keys: np.ndarray, counts: np.ndarray, among: Among | None = None) -> DataFrame:
    """Size, sketches and prefix of each document, or of those that a filter passes."""
    shared = docs.sparkSession.sparkContext.broadcast((keys, counts))
    held = among.reader() if among else None

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("shingles", _HASHES.clear)
        keys, counts = shared.value
        for batch in in_chunks(batches):
            if held is not None:
                batch = batch[held(batch)]
                if batch.empty:  # its columns would have no types
                    continue
            sets = [shingle_set(t, width) for t in batch["text"]]
            sketches = [parities(s) for s in sets]
            yield pd.DataFrame({
                "doc_id": ids_of(batch),
                "n": [len(s) for s in sets],
                "set_id": [np.int64(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64)) for s in sets],
                "parity": sketches,
                "fold": [folded(x) for x in sketches],
                "prefix": [in_order(s, keys, counts, prefix_length(len(s), percent) if len(s) else 0).view(np.int64) for s in sets],
            })

    return docs.select(*id_columns(), "text", *([among.slot()] if among else [])).mapInPandas(features, "doc_id long, n long, set_id long, parity binary, fold binary, prefix array<long>")


def _allowed(percent: int, size_a, at_a, size_b, at_b):
    """Whether documents whose first common shingle is at these positions can be linked."""
    left = np.minimum(size_a - at_a, size_b - at_b)
    return ((100 + percent) * left >= percent * (size_a + size_b)) & (100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b))


def _region_pass(percent: int, pivots: int):
    """Over rows sorted by region: pairs with the region's pivots, and the rows of regions with more documents."""

    columns = ("s", "rep", "n", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heads = [np.empty(0, np.int64)] * 4  # the pivots of the region that the last batch left open
        seen = 0  # rows of it so far
        for batch in batches:
            s, rep, n, at = (np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(heads, columns, strict=True))
            carried, row = len(heads[0]), np.arange(len(s))
            starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            start = starts[np.cumsum(np.append(0, s[1:] != s[:-1]))]
            rank = row - start
            if carried:
                rank[(start == 0) & (row >= carried)] += seen - carried
            fresh = row >= carried
            out = []
            for k in range(pivots):
                here = np.flatnonzero(fresh & (rank > k))
                to = start[here] + k
                fits = (rep[to] != rep[here]) & _allowed(percent, n[to], at[to], n[here], at[here])
                h, to = here[fits], to[fits]
                out.append(pd.DataFrame({"s": s[h], "a": rep[to], "b": rep[h], "n": n[h], "at": at[h], "kind": 0}))
            # Rows of regions with two documents or more, for the next pass.
            last = starts[-1]
            count = np.diff(np.append(starts, len(s)))[np.cumsum(np.append(0, s[1:] != s[:-1]))]
            held = np.flatnonzero((count > 1) & (fresh | (rank == 0)))
            out.append(pd.DataFrame({"s": s[held], "a": rep[held], "b": rep[held], "n": n[held], "at": at[held], "kind": 1}))
            yield pd.concat(out, ignore_index=True)
            seen = rank[-1] + 1
            heads = [x[last : last + pivots] for x in (s, rep, n, at)]

    return run


def may_link(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity sketches of points (rep, n, parity) allow to be linked; it loses no link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            apart = np.fromiter(map(bits_apart, batch["x"], batch["y"]), np.int64, len(batch))
            total = (batch["n_a"] + batch["n_b"]).to_numpy()
            yield batch.loc[(100 + percent) * apart <= (100 - percent) * total, ["a", "b"]]

    x = points.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("x"))
    y = points.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("y"))
    return pairs.select("a", "b").join(y, "b").join(x, "a").mapInPandas(run, "a long, b long").distinct()


def verified(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Exact common and united shingles of pairs (a, b) of doc_ids: a, b, common, united."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))

    among = Among(ids, "id")
    held = among.reader()

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remember_only("shingles", _HASHES.clear)
        for batch in in_chunks(batches):
            batch = batch[held(batch)]
            if batch.empty:
                continue
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "shingles": [shingle_set(t, width).tobytes() for t in batch["text"]]})

    named = docs.where("doc_id is not null").select("doc_id", "text", among.slot()).mapInPandas(sets, "doc_id long, shingles binary")

    def overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            common, united = [], []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                common.append(same)
                united.append(len(x) + len(y) - same)
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "common": common, "united": united})

    x = named.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    y = named.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(y, "b").join(x, "a").mapInPandas(overlaps, "a long, b long, common long, united long")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of the edges (a, b) reaches: node, component.

    Smallest label of the neighbours, then a jump to the label's own label,
    until nothing changes; every round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        step = materialize(step.join(jump, "to", "left").select("node", F.least("to", "further").alias("component"), "was"), "labels")
        labels = step.select("node", "component")
        if step.where("component <> was").isEmpty():
            return labels


def _cells(percent: int):
    """Over rows with their region's pivots: a row for each cell that the document or its window falls into."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = _words(batch["fold"])
            centres = np.full((len(batch), CELLS, FOLDED), 0, np.uint64)
            there = np.zeros((len(batch), CELLS), bool)
            for i, x in enumerate(batch["pivots"]):
                x = np.frombuffer(x, np.uint64).reshape(-1, FOLDED)
                centres[i, : len(x)], there[i, : len(x)] = x, True
            far = np.where(there, np.bitwise_count(centres ^ own[:, None]).sum(axis=2).astype(np.int64), 1 << 40)
            # A linked document has at most 100 * n / percent shingles.
            n = batch["n"].to_numpy(float)
            radius = (100 - percent) / (100 + percent) * n * (1 + 100 / percent)
            row, cell = np.nonzero(far - far.min(axis=1, keepdims=True) <= 2 * radius[:, None] + 1e-6)
            yield batch.drop(columns=["pivots"]).iloc[row].assign(cell=cell)

    return run


_REGION = "region long, rep long, n long, at long, component long, fold binary"


def cut_regions(rows: DataFrame, percent: int, most: int = MOST_ROWS, levels: int = LEVELS) -> DataFrame:
    """Rows of regions, with those of more than `most` rows cut into cells, or else into pairs of blocks.

    Two rows of a region whose documents can be linked are together in one of its parts.
    """
    done = None
    for level in range(levels + 1):
        sized = materialize(rows.join(rows.groupBy("region").agg(F.count("*").alias("size")), "region"), "jaccard-sized")
        small = sized.where(f"size <= {most}").drop("size")
        done = small if done is None else done.unionByName(small)
        large = sized.where(f"size > {most}")
        if large.isEmpty():
            return done
        draw = F.xxhash64("rep", F.lit(level))
        pivots = large.groupBy("region", F.pmod(draw, F.lit(CELLS)).alias("slot")).agg(F.min(F.struct(draw, "fold")).alias("p"))
        # At most CELLS a region; spread over salts, as a region can hold a large share of the rows.
        pivots = pivots.groupBy("region").agg(F.expr("aggregate(collect_list(p.fold), x'', (x, y) -> x || y)").alias("pivots"))
        pivots = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
        dealt = large.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(16)).cast("int")).join(pivots, ["region", "salt"]).drop("salt")
        dealt = materialize(dealt.mapInPandas(_cells(percent), _REGION + ", size long, cell long"), "jaccard-cells")
        work = dealt.groupBy("region", "size", "cell").agg(F.count("*").alias("k")).groupBy("region", "size").agg(F.sum(F.col("k") * F.col("k")).alias("pairs"))
        useful = materialize(work.select("region", F.expr(f"{level} < {levels} AND 2 * pairs <= size * size").alias("useful")), "jaccard-useful")
        # What pivots cannot cut goes into pairs of blocks of half the rows that a task compares.
        count, other = F.expr(f"(2 * size + {most} - 1) div {most}"), F.col("other")
        blocks = large.join(useful.where("NOT useful"), "region").withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        blocks = blocks.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn("region", F.xxhash64("region", F.lit("blocks"), F.least("block", other), F.greatest("block", other)))
        done = done.unionByName(blocks.select(*small.columns))
        rows = dealt.join(useful.where("useful"), "region").withColumn("region", F.xxhash64("region", F.lit(level), "cell")).select(*small.columns)
    return done


def _words(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(-1, FOLDED)


def _compare(percent: int, nearest: bool):
    """Over rows sorted by region and size: the pairs between components that sizes, positions and sketches allow; `nearest`: one for each two components of a region."""

    columns = ("region", "rep", "n", "at", "component")

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        region, rep, n, at, component = (frame[c].to_numpy() for c in columns)
        own = _words(frame["fold"])
        left, right, apart = [], [], []
        x = np.arange(len(frame))
        for k in range(1, len(frame)):
            x = x[x + k < len(frame)]
            # Rows are sorted by size, so what is too large for a row stays so.
            x = x[(region[x] == region[x + k]) & (100 * n[x] >= percent * n[x + k])]
            if not len(x):
                break
            i = x[component[x] != component[x + k]]
            i = i[_allowed(percent, n[i], at[i], n[i + k], at[i + k])]
            bits = np.bitwise_count(own[i] ^ own[i + k]).sum(axis=1).astype(np.int64)
            fits = (100 + percent) * bits <= (100 - percent) * (n[i] + n[i + k])
            left.append(i[fits])
            right.append(i[fits] + k)
            apart.append(bits[fits])
        if not left:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        left, right, apart = map(np.concatenate, (left, right, apart))
        if nearest:
            low, high = np.minimum(component[left], component[right]), np.maximum(component[left], component[right])
            by = np.lexsort((apart, high, low, region[left]))
            key = np.stack([region[left], low, high])[:, by]
            first = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))[: len(by)]
            left, right = left[by[first]], right[by[first]]
        return pd.DataFrame({"a": np.minimum(rep[left], rep[right]), "b": np.maximum(rep[left], rep[right])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # rows of the region that the last batch left open
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            end = int(np.searchsorted(batch["region"].to_numpy(), batch["region"].iloc[-1])) if len(batch) else 0
            if end:
                yield pairs(batch.iloc[:end])
            rest = batch.iloc[end:]
        if rest is not None and len(rest):
            yield pairs(rest)

    return run


def between_components(members: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int, nearest: bool, most: int) -> DataFrame:
    """Pairs (a, b) of documents of different components that share a region and can be linked."""
    member = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_regions = (
        member.groupBy("s", "component").agg(F.min("n").alias("n"))
        .groupBy("s").agg(F.count("*").alias("parts"), F.min("n").alias("least")).where("parts > 1")
    )
    member = member.join(open_regions.select("s", "least"), "s").where(f"{100 + percent} * (n - at) >= {percent} * (n + greatest(least, n * {percent} div 100))")
    rows = member.select(F.col("s").alias("region"), "rep", "n", "at", "component").join(sketches.select("rep", "n", "fold"), ["rep", "n"])
    rows = cut_regions(rows.select("region", "rep", "n", "at", "component", "fold"), percent, most)
    return rows.repartition("region").sortWithinPartitions("region", "n", "rep").mapInPandas(_compare(percent, nearest), "a long, b long").distinct()


def jaccard_components(documents: DataFrame, width: int = 5, percent: int = 80, pivots: int = PIVOTS, most: int = MOST_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id per row of documents.

    Documents whose sets of `width`-word shingles have 100 * intersection >=
    percent * union are linked; component_id is the smallest doc_id reachable
    by links. `pivots` are the documents of a region that meet all others,
    `most` are the rows of a region that one task compares.
    """
    small_batches(documents.sparkSession, "1m")
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keys, counts = _order(docs, width)
    features = materialize(_features(docs, width, percent, keys, counts), "jaccard-features")
    points = features.where("n > 0 and doc_id is not null").groupBy("set_id", "n").agg(F.min("doc_id").alias("rep"))
    points = materialize(points, "jaccard-points")
    held = points.select(F.col("rep").alias("doc_id"), "set_id")

    # Regions that are large in the first order: their shingles go to the end of the second.
    # Copies count as well here, which spares a join and changes no result.
    first = features.where("n > 0 and doc_id is not null").select("doc_id", F.explode("prefix").alias("s"))
    large = first.groupBy("s").count().where(f"count > {LARGE}").orderBy(F.desc("count"), "s").limit(MOST_COMMON)
    large = materialize(large, "jaccard-large")
    found = large.toPandas()
    chosen = features.where("n > 0").select("doc_id", "set_id", "n", "prefix")
    if len(found):
        order = pd.concat([pd.DataFrame({"s": keys.view(np.int64), "count": counts}), found]).groupby("s")["count"].max()
        # At most MOST_COMMON rows are sent to the tasks.
        moved = Among(first.join(F.broadcast(large.select("s")), "s", "left_semi").select(F.col("doc_id").alias("id")).distinct(), "id")
        anew = _features(docs.where("doc_id is not null"), width, percent, *_sorted(order.index, order), moved)
        chosen = moved.without(chosen).unionByName(anew.where("n > 0").select("doc_id", "set_id", "n", "prefix"))
    rows = (
        chosen.join(held, ["doc_id", "set_id"], "left_semi").dropDuplicates(["doc_id", "set_id"])
        .select(F.col("doc_id").alias("rep"), "n", F.posexplode("prefix").alias("at", "s"))
        .select("s", "rep", "n", F.col("at").cast("long"))
    )
    passed = rows.repartition("s").sortWithinPartitions("s", "at", "n", "rep").mapInPandas(
        _region_pass(percent, pivots), "s long, a long, b long, n long, at long, kind int"
    )
    passed = materialize(passed, "jaccard-regions")
    sketches = features.select(F.col("doc_id").alias("rep"), "set_id", "n", "parity", "fold").join(points, ["rep", "set_id", "n"], "left_semi").dropDuplicates(["rep", "set_id"])
    sketches = materialize(sketches, "jaccard-sketches")
    pairs = materialize(may_link(passed.where("kind = 0").select("a", "b").distinct(), sketches, percent), "jaccard-pairs")
    checked = materialize(verified(docs, pairs, width), "jaccard-checked")
    linked = F.expr(f"100 * common >= {percent} * united")
    # Copies of a text that repeat a doc_id tie their sets together.
    tied = points.select(F.col("rep").alias("a")).join(features.where("n > 0").select("doc_id", "set_id", "n"), F.col("a") == F.col("doc_id")).join(
        points.withColumnRenamed("rep", "b"), ["set_id", "n"]
    ).where("a <> b").select("a", "b")
    edges = materialize(checked.where(linked).select("a", "b").union(tied), "jaccard-links")
    labels = components(edges)

    # In a region of as many documents as pivots and one, the pivots have met all.
    members = passed.where("kind = 1").select("s", F.col("a").alias("rep"), "n", "at").distinct()
    members = materialize(members.join(members.groupBy("s").count().where(f"count > {pivots + 1}").select("s"), "s", "left_semi"), "jaccard-members")

    # Regions of several components: the nearest of each two components, then all that are left.
    known = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for nearest in (True, False):
        again = between_components(members, labels, sketches, percent, nearest, most)
        again = materialize(may_link(again.join(known, ["a", "b"], "left_anti"), sketches, percent), "jaccard-again")
        if again.isEmpty():
            continue
        more = materialize(verified(docs, again, width), "jaccard-checked")
        known = known.union(more.select("a", "b"))
        more = more.where(linked).select("a", "b")
        if not more.isEmpty():
            edges = materialize(edges.union(more), "jaccard-links")
            labels = components(edges)
    of_set = points.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set_id", "n", F.coalesce("component", "rep").alias("component"))
    return (
        features.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id"))
        .join(of_set, ["set_id", "n"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    )


def keep_one(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """documents, all columns, of which each component keeps its first row.

    Rows are told apart by their number in a written table, so that null and
    repeated doc_ids do not matter: of equal rows one stays. Rows without words
    are linked with nothing and all stay. An empty table stays empty.
    """
    own = free_name(documents, "_row")
    docs = numbered(documents, own)
    found = jaccard_components(docs.select(F.col(own).alias("doc_id"), "text"), width, percent)
    gone = materialize(found.where("component_id <> doc_id").select(F.col("doc_id").alias(own)), "jaccard-gone")
    return docs.join(gone, own, "left_anti").select(*documents.columns)
