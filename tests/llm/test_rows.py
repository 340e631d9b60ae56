"""Packing, sharding, token counts, page extraction and quality rules, row by row against plain versions."""

import html
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from shelfcast.llm import linefreq, packing, pagetree, sharding, tokencount
from tests.llm.conftest import docs_of, words
from tokenizers import Tokenizer

WORDS_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTES_BPE = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return np.array([*Tokenizer.from_file(WORDS_BPE).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check_packing(rows, pieces, size):
    """Each id lies in one piece, and each sequence is filled without a gap."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    want = Counter()
    for d, t in rows:
        ids = ids_of(t)
        for a in range(0, len(ids), size):
            want[d, a, len(ids[a : a + size]), zlib.crc32(ids[a : a + size].tobytes()), len(ids)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == want
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(p.length for p in pieces) / (size * max(1, len(by_sequence)))


def test_packed_pieces(spark, rng):
    rows = [(i, " ".join(words(rng, min(400, int(rng.lognormvariate(3, 1)))))) for i in range(400)] + [(7, "twice"), (7, "twice")]
    assert check_packing(rows, packing.packed_pieces(docs_of(spark, rows), size=256).collect(), 256) > 0.97


def test_packing_hard_rows(spark, hard_docs, no_docs):
    pieces = packing.packed_pieces(hard_docs, size=64).collect()
    check_packing([(r.doc_id, r.text) for r in hard_docs.collect()], pieces, 64)
    assert packing.packed_pieces(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_shortest_pack_first(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 100, 4096])
    histogram = {rng.randint(1, size): rng.randint(1, 5000) for _ in range(rng.randint(1, 300))}
    slots = packing.shortest_pack_first(histogram, size)
    placed, room = Counter(), defaultdict(int)
    for s in slots:
        placed[s.length] += s.sequences * s.copies
        assert s.offset == room[s.pattern]
        room[s.pattern] += s.length * s.copies
    assert placed == Counter(histogram) and max(room.values()) <= size


def test_encoder_equals_the_library():
    rng = random.Random(3)
    parts = [*"aB1.'! <|>é×…́ sSt\n%É½ß中 \x0b", "'s", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", "ﬁ", "İ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)]
    library = Tokenizer.from_file(WORDS_BPE).encode_batch(texts, add_special_tokens=False)
    for text, mine, own in zip(texts, packing.Encoder(WORDS_BPE).encode(pa.array(texts)), library):
        assert mine.tolist() == own.ids, repr(text)


def test_encoder_remembers_in_little_memory(monkeypatch):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 200_000, dtype=np.uint64))
    sizes = rng.integers(1, 4, len(keys))
    starts = np.cumsum(sizes) - sizes
    tracemalloc.start()
    units = packing.Units()
    for part in np.array_split(rng.permutation(len(keys)), 20):
        part = np.sort(part)
        flat = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in part]).astype(np.uint32)
        units.add(keys[part], flat, sizes[part])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 60 * len(keys)  # a dict of as many numbers takes more than twice as much
    ids, found = units.ids_at(units.places(keys))
    assert found.tolist() == sizes.tolist() and ids.tolist() == list(range(int(sizes.sum())))

    monkeypatch.setattr(packing, "KEPT_UNITS", 40)  # generations that go and units that come again
    monkeypatch.setattr(packing, "GROUP", 200)
    texts = [" ".join(f"unit{i % 90}" for i in range(a, a + 30)) for a in range(0, 2000, 7)]
    library = Tokenizer.from_file(WORDS_BPE).encode_batch(texts, add_special_tokens=False)
    assert [i.tolist() for i in packing.Encoder(WORDS_BPE).encode(pa.array(texts))] == [c.ids for c in library]


def test_token_counts(spark, rng, hard_docs, no_docs):
    texts = [" ".join(words(rng, rng.randint(0, 300))) for _ in range(40)]
    texts += ["x" * 3000, " " * 900 + "a b  c\n\n d " * 200, "a<|endoftext|>b " * 300, "é́ it's  l'été 中文 " * 300, "a " * 2000, None, ""]
    rows = list(enumerate(texts))
    library = Tokenizer.from_file(BYTES_BPE)
    want = sorted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    for chunk, overlap in ((tokencount.CHUNK, tokencount.OVERLAP), (400, 30), (150, 8)):
        assert sorted(map(tuple, tokencount.token_counts(docs_of(spark, rows), chunk=chunk, overlap=overlap).collect())) == want
    hard = [(r.doc_id, r.text or "") for r in hard_docs.collect()]
    found = Counter(tuple(r) for r in tokencount.token_counts(hard_docs, chunk=5000).collect())
    assert found == Counter((d, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for d, t in hard)
    assert tokencount.token_counts(no_docs).count() == 0


def test_token_counts_encode_a_piece_once(monkeypatch):
    """Pieces between lone blanks are counted as inside the whole text, and remembered up to a bound."""
    texts = ["it's a  b", " a b ", "b\u00a0 b\x1c b \x85b", "x <|endoftext|> y<|endoftext|> 's 't", "caf\u00e9 12 . .. \n a\t b", "", " ", "a b a b"] * 3
    library, seen = Tokenizer.from_file(BYTES_BPE), []

    class Recorder:
        def encode_batch_fast(self, pieces, add_special_tokens):
            seen.extend(pieces)
            return library.encode_batch_fast(pieces, add_special_tokens=add_special_tokens)

    monkeypatch.setattr(tokencount, "tokenizer", lambda path: Recorder())
    made = {"doc_id": range(len(texts)), "n_bytes": [0] * len(texts), "text": texts}
    batch = pa.RecordBatch.from_pydict({k: list(v) for k, v in made.items()})
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    for most, times in ((400_000, 1), (0, 2)):
        seen.clear()
        monkeypatch.setattr(tokencount, "KEPT_PIECES", most)
        found = [n for out in tokencount._counts(BYTES_BPE)([batch, batch]) for n in out.column("n_tokens").to_pylist()]
        assert found == want * 2
        assert max(Counter(seen).values()) == times


def test_sharding(spark, rng, hard_docs, no_docs):
    rows = [(i, "x" * rng.randint(0, 60)) for i in range(300)] + [(5, "same text here")] * 200 + [(6, "y" * k) for k in range(40)]
    rows += [(7, "z" * 5000), (None, "q"), (None, None)]
    got = sharding.sharded(docs_of(spark, rows), limit=500).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((d, len(t or "")) for d, t in rows)
    sizes, count = Counter(), Counter()
    for r in got:
        sizes[r.shard, r.part] += r.n_bytes
        count[r.shard, r.part] += 1
    assert all(sizes[r.shard, r.part] == r.shard_bytes for r in got)
    assert all(s <= 500 or count[k] == 1 for k, s in sizes.items())
    shards = {r.shard for r in got}
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)  # buckets do not overlap
    parents = {s[:-1] for s in shards if s}
    total = {p: sum(n for (s, _), n in sizes.items() if s.startswith(p)) for p in parents}
    assert all(n > 500 for n in total.values())  # only oversized buckets were split
    assert sharding.sharded(hard_docs, 100).count() == hard_docs.count()
    assert sharding.sharded(no_docs).count() == 0


def page(*parts):
    return f"<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body>{''.join(parts)}</body></html>"


def test_extraction(spark, rng):
    rows, want = [], {}
    for i in range(60):
        paragraphs = [" ".join(words(rng, rng.randint(1, 30))) + " &amp; caf&eacute;" for _ in range(rng.randint(1, 6))]
        body = "".join(rng.choice(["<p>{}</p>", "<p><b>{}<br>", "<div class='text'>{}</div>"]).format(p) for p in paragraphs)
        noise = [
            "<header><h2>Site</h2></header><nav><ul><li><a href=/>Home<li><a>About</ul></nav>",
            f"<div class='ad'>Buy {i}</div><div id=cookie-notice>We use cookies</div><form><label>Name</label><input value=x></form>",
        ]
        tail = f"<div class='promo-box x9'>Same words on all pages</div><div class=comments><p>{' '.join(words(rng, 9))}</p></div><footer>&copy; {i}</footer>"
        holder = "div class='story'" if i % 2 else "article"
        rows.append((i, f"http://h{i % 2}.example.com/{i}", page(*noise, f"<{holder}><h1>Title {i}</h1>{body}</{holder.split()[0]}>", tail)))
        want[i] = "\n".join([f"Title {i}", *(html.unescape(p) for p in paragraphs)])
    rows += [(100, None, None), (101, "x", ""), (102, "http://h0.example.com/", "no markup\n at   all"), (103, "http://one.example.org", "<p>a<p>b &lt; c<script>x")]
    want |= {100: "", 101: "", 102: "no markup at all", 103: "a\nb < c"}
    schema = "page_id long, url string, html string, text string, cut string, host int"
    pages = spark.createDataFrame([(*r, "t", "c", 1) for r in rows], schema)
    assert {r.page_id: r.text for r in pagetree.extracted(pages).collect()} == want
    tree = {(r.host, r.path): r.importance for r in pagetree.style_tree(pages.select(pagetree.host_of(pages.url).alias("host"), "html").na.fill("")).collect()}
    assert tree["h1.example.com", "/html/body/div.promo-box.x9"] == 0  # on each page the same: cut by the tree alone
    assert tree["h1.example.com", "/html/body/div.story"] > 0.8
    assert pagetree.extracted(pages.limit(0)).count() == 0


def test_copies_of_one_page_keep_their_text(spark):
    one = page("<div class=story><p>all there is</p></div>")
    pages = spark.createDataFrame([(i, "http://c.example.com/", one) for i in range(30)], "page_id long, url string, html string")
    assert {r.text for r in pagetree.extracted(pages).collect()} == {"all there is"}


def repeated(items, n=5):
    held = defaultdict(list)
    for i in range(len(items) - n + 1):
        held[tuple(items[i : i + n])].append(i)
    return len({j for places in held.values() if len(places) > 1 for i in places for j in range(i, i + n)})


def quality_rows(rng):
    texts = []
    for i in range(150):
        lines = [" ".join(words(rng, rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), f"Read more  about item {rng.randint(1, 9)} HERE")
        if i % 11 == 0:
            lines += lines
        if i % 13 == 0:
            lines.append("up and down " * 9 + "#*$%")
        texts.append("\n".join(lines))
    return list(enumerate(texts)) + [(200, texts[0]), (201, None), (202, "é x y z #|")]


def test_quality_rules(spark, rng):
    rows = quality_rows(rng)
    got = {r.doc_id: r for r in linefreq.line_verdicts(docs_of(spark, rows)).collect()}
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", x.lower())).strip(" ")
    held = defaultdict(set)
    for _, t in rows:
        for x in (t or "").split("\n"):
            held[norm(x)].add(t)
    often = {x for x, ts in held.items() if len(ts) > max(20, 0.05 * len({t or "" for _, t in rows}))}
    for d, t in rows:
        w, lines = re.findall(r"[^\x20\x09-\x0D]+", t or ""), [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        lost = sum(len(x.split()) for x in lines if norm(x) in often)
        failed = len(w) < 10 or 100 * repeated(w) > 20 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeated(w), lost, failed)
        assert tuple(got[d])[1:8] == want, (d, tuple(got[d]), want)
        assert got[d].kept == (not failed and lost <= 0.5 * len(w) and len(w) - lost >= 10)
    kept = {r.doc_id: r for r in linefreq.clean_documents(docs_of(spark, rows)).collect()}
    assert set(kept) == {d for d, r in got.items() if r.kept}
    for d, t in rows:
        if d in kept:
            rest = "\n".join(x for x in t.split("\n") if norm(x) not in often or not x.strip())
            assert (kept[d].text, kept[d].n_chars) == (rest, len(rest))


def test_quality_rules_equal_sql(spark, rng):
    rows = quality_rows(rng)
    docs = docs_of(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = linefreq.line_verdicts(docs)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({linefreq.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_quality_hard_rows(spark, hard_docs, no_docs):
    got = linefreq.line_verdicts(hard_docs).collect()
    assert len(got) == hard_docs.count() and {r.base_failed for r in got if r.doc_id in (901, 902, 903)} == {True}
    assert linefreq.clean_documents(hard_docs).columns == hard_docs.columns
    assert linefreq.line_verdicts(no_docs).count() == 0
