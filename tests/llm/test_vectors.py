"""Hard negatives, byte-level BPE and fill-in-the-middle against plain versions."""

import hashlib
import math
import random
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from shelfcast.llm import bytepairs, hardneg, infill, queries
from tests.llm.conftest import docs_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TABLES = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, key string, `rank` int"


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytepairs.read_ranks(RANKS), special_tokens={})


def brute_negatives(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    """Every anchor against every row, in whole numbers."""
    seen = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        seen[vec_id, label, whole] = None
    size = max((len(v) for _, _, v in seen), default=0)
    all_rows = [(i, label, v + (0,) * (size - len(v))) for i, label, v in seen]
    out = []
    for i, label, v in all_rows:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in all_rows)
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:positives]:
            fit = [(n, k) for n, k, other in scored if other != label and least * -p <= 100 * -n <= most * -p][:negatives]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % 5 == 0, **how).collect())


@pytest.mark.parametrize("dim, sizes", [(3, (16, 8)), (70, (10**6, 10**6)), (64, (50, 7))])
def test_hard_negatives(spark, dim, sizes):
    rng = random.Random(dim)
    rows = []
    for i in range(260):
        vector = [rng.gauss(0.1, 0.3) for _ in range(dim)]
        if i % 3 == 0:  # a third of all rows hold one vector
            vector = [0.25] * dim
        rows.append((i, vector, rng.choice([0, 0, 0, 1, 2])))
    got = mined(spark, rows, sizes=sizes)
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and len(got) > 100


def test_hard_negatives_of_odd_rows(spark):
    rows = [
        (None, [1.0, 0.0], 1),
        (0, None, 1),
        (5, [0.5, 0.5], None),
        (10, [1.0, None], 1),
        (15, [float("nan"), 1.0], 1),
        (20, [float("inf"), 1.0], 1),
        (25, [1.0, 0.5], 1),
        (25, [1.0, 0.5], 1),  # the same row twice
        (25, [0.5, 1.0], 2),  # the same id, another row
        (30, [], 1),
        (35, [0.9], 1),  # shorter
        (40, [-1.0, -1.0], 1),
        (41, [0.8, 0.1], 2),
        (42, [0.8, 0.1], 3),
        (43, [0.8, 0.1], 3),
        (44, [700.0, -900.0], 3),
        (45, [0.0, 0.0], 4),
        (50, [0.0, 0.0], 4),
        (51, [1.0, 0.6], 1),
    ]
    got = mined(spark, rows)
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and got
    assert mined(spark, []) == []
    assert mined(spark, rows[:6]) == []
    assert mined(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)]) == []  # too long for whole numbers


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(5)
    for dim, scale in ((1, 3), (64, 50), (100, 10000)):
        turned = hardneg.Rotations(dim)
        rows, anchors = (rng.integers(-scale, scale + 1, (n, dim)) for n in (300, 20))
        rows[0], anchors[0] = 0, 0
        bits, align, rest = hardneg.codes(rows, turned)
        lower, upper = hardneg.Queries(anchors, turned).bounds(slice(0, 20), bits, align, rest)
        exact = anchors @ rows.T
        assert (lower <= exact).all() and (exact <= upper).all()
        if dim > 1:
            assert np.median(upper - lower) < 0.2 * np.linalg.norm(rows, axis=1).mean() * np.linalg.norm(anchors, axis=1).mean()


def test_survivors_keep_the_best():
    rng = np.random.default_rng(6)
    for _ in range(200):
        exact = rng.integers(-20, 20, 30)
        lower, upper = exact - rng.random(30) * 9, exact + rng.random(30) * 9
        low, high = sorted(rng.integers(-20, 20, 2))
        kept = hardneg.survivors(lower, upper, low, high, 3)
        want = sorted((x for x in exact if low <= x <= high), reverse=True)[:3]
        assert sorted((x for x in exact[kept] if low <= x <= high), reverse=True)[:3] == want


def spans(codec, text, ids):
    """The code points that each id's bytes touch."""
    owner, at, out = [k for k, c in enumerate(text) for _ in c.encode()], 0, []
    for i in ids:
        out.append((owner[at], owner[at + int(codec.widths[i]) - 1] + 1))
        at += int(codec.widths[i])
    return out


def test_codec_equals_the_library(plain):
    rng = random.Random(3)
    parts = [*"aB1.'! <|>é×…́ sSt\n%É½ß中。，x \x0b\x1c\x85 　​", "'s", "'re", "<|endoftext|>", "  ", "😀", "'ll", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(24))) for _ in range(4000)]
    texts += ["a" * 20000, "中文，字" * 3000, "x.y" * 5000, "'s." * 3000, " " * 9000, "word, " * 4000 + "!" * 6000]
    codec = bytepairs.Codec(RANKS, public_tokenizers.PATTERN)
    ids, cuts, starts, ends = codec.encode(texts)
    for text, a, b in zip(texts, cuts, cuts[1:]):
        assert ids[a:b].tolist() == plain.encode_ordinary(text), text[:50]
        assert list(zip(starts[a:b].tolist(), ends[a:b].tolist())) == spans(codec, text, ids[a:b].tolist())
    assert codec.encode(texts, offsets=False)[0].tolist() == ids.tolist()  # out of memory this time


def test_codec_forgets(monkeypatch, plain):
    monkeypatch.setattr(bytepairs, "KEPT_UNITS", 20)
    codec = bytepairs.Codec(RANKS, public_tokenizers.PATTERN)
    for n in range(30):
        text = f"some {n} words {n * 7} and more of them"
        assert codec.encode([text], False)[0].tolist() == plain.encode_ordinary(text)
    assert codec.known < 40


def test_encoded_and_decoded(spark, hard_docs, no_docs, plain):
    rows = bytepairs.encoded(hard_docs)
    texts = sorted((r.doc_id or 0, r.text or "") for r in hard_docs.collect())
    found = sorted((r.doc_id or 0, r.ids, list(zip(r.starts, r.ends))) for r in rows.collect())
    codec = bytepairs.codec(RANKS, public_tokenizers.PATTERN)
    want = [(i, ids, spans(codec, t, ids)) for i, t in texts for ids in [plain.encode_ordinary(t)]]
    assert found == sorted(want)
    back = bytepairs.decoded(rows, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == texts
    assert all(bytes(r.data).decode() == r.text and not r.head and not r.tail for r in back)
    assert bytepairs.encoded(no_docs).count() == 0 and bytepairs.decoded(bytepairs.encoded(no_docs), []).count() == 0


def test_lists_cut_inside_characters(spark, plain):
    text = "naïve 😀😀 中文 \U0001f9d1‍\U0001f680 é" * 3
    ids = plain.encode_ordinary(text)
    pieces = [(n, ids[a : a + 2]) for n, a in enumerate(range(0, len(ids), 2))] + [(900, None), (901, []), (902, [None, -1, 10**6])]
    df = spark.createDataFrame(pieces, "`a.b` int, ids array<int>")
    rows = sorted(bytepairs.decoded(df, ["a.b"]).collect())
    assert b"".join(bytes(r.data) for r in rows).decode() == text
    assert b"".join(bytes(r.head) + r.text.encode() + bytes(r.tail) for r in rows).decode() == text
    assert any(r.tail for r in rows) and all("�" not in r.text for r in rows)
    with pytest.raises(ValueError):
        bytepairs.decoded(df.withColumn("Data", F.lit(1)), ["Data"])


@pytest.mark.parametrize("data, want", [(b"", ("", "", "")), (b"\x80\x80a\xe4\xb8", ("8080", "a", "e4b8")), (b"\xf0\x9f", ("", "", "f09f")), (b"\xc3\xa9", ("", "é", ""))])
def test_whole_characters(data, want):
    head, text, tail = bytepairs.whole_characters(data)
    assert (head.hex(), text, tail.hex()) == want


def test_byte_bpe_query(spark, plain):
    rows = {r.doc_id: r for r in queries.op12_byte_bpe(spark, TABLES).collect()}
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{TABLES}/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for i, text in texts:
        ids = plain.encode_ordinary(text)
        assert (rows[i].n_tokens, rows[i].n_chars) == (len(ids), len(text))
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_rotation():
    rng = random.Random(1)
    for size in (0, 1, 2, 7, 200_001):
        data = bytearray(rng.randbytes(size))
        a, b, c = sorted(rng.randint(0, size) for _ in range(3))
        want = data[:a] + data[b:c] + data[a:b] + data[c:]
        infill.rotate(data, a, b, c)
        assert data == want


def test_infill_round_trip():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices("aé中😀<>PSM \n", k=rng.randrange(12)))
        if any(mark in text for mark in ("<P>", "<S>", "<M>")):
            continue
        a, b = sorted((rng.randint(0, len(text)), rng.randint(0, len(text))))
        parts = text[:a], text[a:b], text[b:]
        for form, want in (("psm", "<P>{0}<S>{2}<M>{1}"), ("spm", "<S>{2}<P>{0}<M>{1}"), ("plain", "{0}{1}{2}")):
            out = infill.transform(text.encode(), form, a, b - a)
            assert out.decode() == want.format(*parts) and infill.restore(bytes(out), form).decode() == text


def brute_infill(doc_id, text):
    text, n = text or "", len(text or "")
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if doc_id is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < 20 else "psm"
    return doc_id, n, form, a, b - a, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_infill_of_documents(spark, hard_docs, no_docs):
    marked = [(i, t) for i, t in enumerate(["x<P>y", "<M>", "a<S", "P>", "ab" * 70000, "é" * 70000, *map(str, range(200))])]
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()] + marked
    made = infill.transformed(docs_of(spark, rows))
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(repr(brute_infill(*r)) for r in rows)
    clash = made.withColumn("x.y", F.lit(3))
    back = infill.restored(clash, ["doc_id", "x.y", "form"]).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in back) == sorted(repr((i, t or "")) for i, t in rows)
    assert {f for _, _, f, *_ in made.collect()} == {"plain", "psm", "spm"}
    assert infill.transformed(hard_docs).count() == hard_docs.count() and infill.digests(no_docs).count() == 0
    nulls = spark.createDataFrame([(None, None), ("abc", None)], "output string, form string")
    assert sorted(r.text for r in infill.restored(nulls, []).collect()) == ["", "abc"]


@pytest.mark.skipif(not Path(TABLES).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_fill_in_middle"])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    df = queries.REGISTRY[name](spark, TABLES)
    cols = ", ".join(df.columns)
    want = con.sql(f"SELECT {cols} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want)) and want
