"""Repeats, runs and alignments of documents against brute force."""

import collections
import hashlib
import itertools
import random
import zlib

import pytest

from cohortlake.llm import alignment, periodic_runs, queries, suffix_dedup

SCHEMA = "doc_id long, text string, n long, seed string, pos string, t1 string"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, 1, "a", "p", "w") for i, t in texts], SCHEMA)


def without_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for g, _ in itertools.groupby(gone) if g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digest(found):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found)


def odd_texts():
    draw = random.Random(5)
    word = lambda k: "".join(draw.choice("abé") for _ in range(k))
    passage, other = word(60), word(200)
    texts = [None, "", "x", passage[:19], passage[:20], passage[3:33], "a" * 150, "a" * 19, "ab" * 60, "abcabcabd" * 30, other, other[:90] + "Z" + other[91:], word(400)]
    texts += [word(draw.randrange(40)) + passage[a:b] + word(draw.randrange(40)) for a in range(0, 30, 7) for b in range(30, 60, 9)]
    texts += [other[k : k + 70] + word(5) + other[k + 70 :] for k in range(0, 120, 30)] + [other, other, passage, None, "\U0001f600" * 40]
    return texts


@pytest.mark.parametrize(("length", "together", "bits"), [(20, 1024, 26), (20, 1, 6), (1, 2, 26)])
def test_repeats_of_odd_texts(spark, monkeypatch, length, together, bits):
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", (1 << min(bits, 16), 1 << bits))
    texts = odd_texts()[: 20 if length == 1 else None]
    ids = [*range(len(texts) - 3), 3, 3, None]  # repeated ids and none
    found = suffix_dedup.remove_repeats(rows(spark, list(zip(ids, texts, strict=True))), length, together).collect()
    assert digest(found) == collections.Counter((i, *x) for i, x in zip(ids, without_repeats(texts, length), strict=True))
    for r in found:
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed and len(r.spans) == 2 * r.n_spans
    assert suffix_dedup.remove_repeats(rows(spark, [])).count() == 0


def test_repeats_of_the_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    found = queries.op13_suffix_array_dedup(spark, data).collect()
    wanted = without_repeats([r.text for r in docs], 200)
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == {(d.doc_id, *x) for d, x in zip(docs, wanted, strict=True)}
    assert sum(r.n_removed for r in found) > 0


def runs_of(w):
    found = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and not any((i, j + q) == x[:2] for x in found):
                found.add((i, j + q, q))
            i = max(j, i + 1)
    return sorted((i, q, j) for i, j, q in found)


def run_row(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_of(w)
    gone = {k for i, q, j in found for k in range(i + q, j)}
    best = min(((i - j, i, q) for i, q, j in found), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{i},{j - i},{q}\n" for i, q, j in found)
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    return (doc_id, len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_odd_texts(spark):
    draw = random.Random(3)
    texts = [None, "", " \n", "a", "a a a a a", "a a a a a a", "b a a a a a a a c", "a b " * 3, "a b " * 4, "x " + "a b " * 4 + "a", "a b c " * 4 + "d " + "a b c " * 5, "a a b a a b a a b a a b", ("a b " * 5 + "c ") * 6]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(6, 90))) for _ in range(60)] + [" ".join(draw.choice("abc") for _ in range(12)) * 7, "z " * 5000, "p q r s t " * 900]
    ids = [*range(len(texts) - 2), 4, None]
    found = queries.digests(periodic_runs.periodic_runs(rows(spark, list(zip(ids, texts, strict=True))), queries.planted)).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(run_row(*x) for x in zip(ids, texts, strict=True))
    assert periodic_runs.periodic_runs(rows(spark, [])).count() == 0


def test_runs_of_the_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("length(text) < 6000").collect()
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, data).collect()}
    assert {d.doc_id: found[d.doc_id] for d in docs} == {d.doc_id: run_row(d.doc_id, d.text) for d in docs}
    assert sum(r[1] > 0 for r in found.values()) >= len(found) // 20


def alignments(texts):
    """Rows of all texts by the two libraries, whole text by whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(queries.vocabulary())
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary(queries.PIECES))
    names = {i: t for t, i in a_side.get_vocab().items()}
    value = alignment.byte_values()
    rows, links_of, seen = [], [], collections.Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(value[c] for c in names[i]) for i in a]
        b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("\u2581", " ").encode() for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = list(itertools.accumulate(map(len, a_bytes))), list(itertools.accumulate(map(len, b_bytes)))
        both = [0, *sorted(set(a_ends) & set(b_ends))]
        groups = ";".join(
            ",".join(str(i) for i, e in zip(a, a_ends, strict=True) if lo < e <= hi) + "|" + ",".join(str(i) for i, e in zip(b, b_ends, strict=True) if lo < e <= hi)
            for lo, hi in itertools.pairwise(both)
        )
        owner_a = [i for i, x in enumerate(a_bytes) for _ in x]
        owner_b = [i for i, x in enumerate(b_bytes) for _ in x]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(owner_a, owner_b, strict=True)))]
        seen.update(set(links))
        links_of.append(links)
        rows.append((len(a), len(b), len(both) - 1, len(links), groups))
    highest = collections.defaultdict(int)
    for (x, _), n in seen.items():
        highest[x] = max(highest[x], n)
    return [(*r[:4], sum(seen[p] == highest[p[0]] for p in links), sum(seen[p] for p in links), hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "", r[4]) for r, links in zip(rows, links_of, strict=True)], seen


ODD_TEXTS = [
    None, "", " ", "  ", "one", "one two", " one  two ", "one two", "tail ", "\n\n x \t y", "a\u2581b and more", "\u2581", "<|endoftext|> is <s> text </s> <unk>", "na\u00efve caf\u00e9 \U0001f600\U0001f600 \u4e2d\u6587",
    "x\u00a0y \u3000z", "3.14, (\"quoted\")... don't!", "zero\x00byte", "<0x41> A", "word " * 3000, "\u0301combining", "end\r\n next",
]


@pytest.mark.parametrize(("spill", "radix", "fan_in"), [(1_000_000, 32, 64), (40, 4, 4)])
def test_alignment_of_odd_texts(spark, spill, radix, fan_in):
    ids = [*range(len(ODD_TEXTS) - 2), 5, None]
    docs = rows(spark, list(zip(ids, ODD_TEXTS, strict=True)))
    wanted, seen = alignments(ODD_TEXTS)
    found = alignment.align(docs, queries.vocabulary(), queries.vocabulary(queries.PIECES), True, spill, radix, fan_in).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter((i, *w) for i, w in zip(ids, wanted, strict=True))
    runs = alignment.spill_runs(docs, queries.vocabulary(), queries.vocabulary(queries.PIECES), spill=spill, radix=radix)
    counted = alignment.pair_counts(alignment.count_pairs(runs, radix, fan_in)).collect()
    assert {(r.a, r.b): r.documents for r in counted} == seen and len(counted) == len(seen)
    assert alignment.align(rows(spark, []), queries.vocabulary(), queries.vocabulary(queries.PIECES)).count() == 0


def test_alignment_of_the_documents_in_few_remembered_parts(spark, data, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_PARTS", 300)
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 20_000)
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    wanted, _ = alignments([d.text for d in docs])
    found = queries.op11_cross_tokenizer_alignment(spark, data).collect()
    assert {tuple(r) for r in found} == {(d.doc_id, *w[:-1]) for d, w in zip(docs, wanted, strict=True)}
