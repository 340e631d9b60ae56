"""Jaccard classes, repeated passages, decontamination and components against brute force."""

import random
import re
from collections import defaultdict
from itertools import combinations

import pyarrow as pa
import pytest
from shelfcast.llm import decontaminate, jaccard, suffixes
from shelfcast.llm.components import components
from shelfcast.llm.texts import split_words, string_buffer
from tests.llm.conftest import docs_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def classes(rows, percent, size):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows)]


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = words(rng, 1)[0]
        out.append(" ".join(own))
    return out


def similar_docs(rng):
    """Families of many degrees of likeness, larger than a short list, with passages that unrelated texts share."""
    texts = [" ".join(words(rng, rng.randint(3, 90))) for _ in range(60)]
    for size, n, edits in ((80, 90, 9), (60, 45, 3), (30, 12, 2), (8, 6, 1)):
        texts += family(rng, words(rng, size), n, edits)
    passage = words(rng, 40)
    texts += [" ".join([*words(rng, rng.randint(5, 60)), *passage]) for _ in range(50)]
    texts += ["a b c", "A B C", "a b", "", None, "Two  words", texts[0], texts[70]]
    return list(enumerate(texts))


@pytest.mark.parametrize(("percent", "size"), [(85, 4), (80, 5), (60, 2)])
def test_jaccard_classes(spark, rng, percent, size):
    rows = similar_docs(rng)
    got = jaccard.jaccard_classes(docs_of(spark, rows), percent, size).collect()
    assert sorted(map(tuple, got)) == sorted(classes(rows, percent, size))


def test_one_of_each_class_stays(spark, rng):
    rows = similar_docs(rng)
    kept = {r.doc_id for r in jaccard.keep_one_per_class(docs_of(spark, rows)).collect()}
    assert kept == {c for _, n, c in classes(rows, 80, 5) if n} | {d for d, n, _ in classes(rows, 80, 5) if not n}


def test_token_lists_move_their_rows_once(spark, monkeypatch):
    rows = [(1, 5, 0, [7, 8, 9]), (1, 5, 0, [7, 8, 9]), (2, 6, 1, [8, 9]), (3, 4, 2, [9, 10]), (4, 4, 2, [11])]
    heads = spark.createDataFrame(rows, "node long, n long, rare long, head array<long>")
    monkeypatch.setattr(jaccard, "checkpointed", lambda df, name: df)
    lists = jaccard._shared_lists(heads)
    plan = spark._jvm.PythonSQLUtils.explainString(lists._jdf.queryExecution(), "simple")
    want = [(8, 1, 5, 0, 2), (8, 2, 6, 1, 2), (9, 1, 5, 0, 3), (9, 2, 6, 1, 3), (9, 3, 4, 2, 3)]
    assert sorted((r.token, r.node, r.n, r.rare, r.m) for r in lists.collect()) == want
    assert plan.count("Exchange hashpartitioning(token") == 1 and "MapInArrow" not in plan


def test_pairs_of_long_lists_come_once(spark, monkeypatch):
    """Two copies of a family that differ in a stretch meet in many lists; each pair is verified once, by one Python worker a task."""
    pairs, plans = [], []
    extend, join = jaccard._extend, jaccard.components

    def extended(sets, fronts, some, *rest):
        pairs.append([tuple(r) for r in some.collect()])
        return extend(sets, fronts, some, *rest)

    def joined(links):
        plans.append(spark._jvm.PythonSQLUtils.explainString(links._jdf.queryExecution(), "simple"))
        return join(links)

    monkeypatch.setattr(jaccard, "_extend", extended)
    monkeypatch.setattr(jaccard, "components", joined)
    rng = random.Random(5)
    base = words(rng, 120)
    texts = family(rng, base, 60, 3) + family(rng, base[:100] + words(rng, 20), 60, 3)
    rows = list(enumerate(texts))
    got = jaccard.jaccard_classes(docs_of(spark, rows), 85, 4).collect()
    assert sorted(map(tuple, got)) == sorted(classes(rows, 85, 4))
    assert len(pairs) == 2 and pairs[1] and len(pairs[1]) == len(set(pairs[1]))
    assert [p.count("MapInArrow") for p in plans] == [1, 1]


def test_jaccard_hard_rows(spark, hard_docs, no_docs):
    got = jaccard.jaccard_classes(hard_docs).collect()
    assert len(got) == hard_docs.count()
    assert {r.component_id for r in got if r.doc_id == 905} == {905}
    assert [r.component_id for r in got if r.n_shingles == 0 and r.doc_id] == [r.doc_id for r in got if r.n_shingles == 0 and r.doc_id]
    kept = jaccard.keep_one_per_class(hard_docs)
    assert kept.columns == hard_docs.columns
    assert kept.where("doc_id = 905").count() == 1 and kept.where("doc_id = 906").count() == 2
    assert jaccard.jaccard_classes(no_docs).count() == jaccard.keep_one_per_class(no_docs).count() == 0


def test_components(spark, rng):
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    root = list(range(400))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in linked)


def covered(rows, least):
    """Word places in a passage of ``least`` words that another document holds, and of those that an earlier one holds."""
    held = defaultdict(list)
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - least + 1):
            held[tuple(w[i : i + least])].append((d, i))
    both = defaultdict(set), defaultdict(set)
    for places in held.values():
        if len({d for d, _ in places}) > 1:
            first = min(d for d, _ in places)
            for d, i in places:
                both[0][d].update(range(i, i + least))
                if d > first:
                    both[1][d].update(range(i, i + least))
    return both


def found_words(spans):
    found = defaultdict(set), defaultdict(set)
    for s in spans.collect():
        for kind in (0, 1) if s.later else (0,):
            found[kind][s.doc_id].update(range(s.start_word, s.end_word))
    return found


@pytest.mark.parametrize("least", [50, 20])
def test_repeated_passages(spark, rng, least):
    passages = [words(rng, n) for n in (least - 1, least, least + 1, 3 * least, 200)]
    rows = []
    for i in range(80):
        own = words(rng, rng.randint(0, 60))
        for p in rng.sample(passages, rng.randint(0, 2)):
            own += p + words(rng, rng.randint(1, 30))
        rows.append((i, " ".join(own)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "once " * 400), (103, " ".join(passages[4] * 3))]
    want = covered(rows, least)
    for parts in (1, 4):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = found_words(suffixes.repeated_spans(docs_of(spark, rows), least))
        assert found[0] == want[0]
        if parts == 1:  # a run that is cut keeps a first copy in each part
            assert found[1] == want[1]
        assert all(found[1][d] <= want[1][d] for d in found[1])


@pytest.mark.parametrize("tail", [30, 45])
def test_passages_that_end_in_a_common_sentence(spark, rng, tail):
    """Many documents hold the words in which a passage of two documents ends, or hold them several times."""
    common, rows = words(rng, tail), []
    for i in range(0, 160, 2):
        passage = words(rng, 55 - tail) + common
        rows += [(i + k, " ".join([*words(rng, 20), *passage, *words(rng, 20)])) for k in (0, 1)]
    for i in range(200, 600):
        rows.append((i, " ".join([*words(rng, 30), *common, *words(rng, 5), *(common if i % 3 else []), *words(rng, 30)])))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    found, want = found_words(suffixes.repeated_spans(docs_of(spark, rows))), covered(rows, 50)
    assert found[0] == want[0] and found[1] == want[1]


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_one_copy_of_a_passage_stays(spark, rng, parts):
    """A third of the rows hold a passage whose surroundings all differ, so that its run goes over all partitions."""
    passage = words(rng, 60)
    rows = [(i, " ".join([*words(rng, 30), *(passage if i % 3 == 1 else []), *words(rng, 30)])) for i in range(900)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    found, want = found_words(suffixes.repeated_spans(docs_of(spark, rows))), covered(rows, 50)
    assert found[0] == want[0] and found[1] == want[1]
    assert len(found[0]) == 300 and set(found[0]) - set(found[1]) == {1}


def test_cut_text_keeps_the_rest(spark, rng):
    passage, a, b = words(rng, 60), words(rng, 30), words(rng, 30)
    text = lambda *parts: "\n".join(" ".join(p) for p in parts)
    rows = [(1, text(a, passage)), (2, text(b, passage, a[:5])), (3, text(passage)), (4, text(b[:10]))]
    got = {r.doc_id: (r.text, r.n_chars) for r in suffixes.drop_repeats(docs_of(spark, rows)).collect()}
    assert got[1][0] == rows[0][1] and got[4][0] == rows[3][1] and 3 not in got
    assert got[2] == (text(b, a[:5]), len(text(b, a[:5])))


def test_texts_are_cut_by_one_python_worker(spark, rng):
    passage = words(rng, 60)
    rest = suffixes.drop_repeats(docs_of(spark, [(i, " ".join([*words(rng, 20), *passage])) for i in range(3)]))
    plan = spark._jvm.PythonSQLUtils.explainString(rest._jdf.queryExecution(), "simple")
    assert plan.count("ArrowEvalPython") == 1 and rest.count() == 3


def test_passages_hard_rows(spark, hard_docs, no_docs):
    assert suffixes.repeated_spans(hard_docs).count() == 0  # identical rows are one document
    rest = suffixes.drop_repeats(hard_docs)
    assert rest.columns == hard_docs.columns and sorted(rest.collect(), key=str) == sorted(hard_docs.collect(), key=str)
    assert suffixes.repeated_spans(no_docs).count() == suffixes.drop_repeats(no_docs).count() == 0


def edited(rng, item, edits):
    own = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(own)), rng.random()
        if kind < 0.5:
            own[at] = words(rng, 1)[0]
        elif kind < 0.75:
            del own[at]
        else:
            own.insert(at, words(rng, 1)[0])
    return own


def distance(item, text):
    """Least edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_contaminated(spark, rng):
    items = [words(rng, n) for n in (14, 20, 35, 60) for _ in range(10)]
    rows, edits = [], {}
    for i in range(300):
        k, e = rng.randrange(len(items)), rng.choice([0, 0, 1, 2, 3])
        e = min(e, len(items[k]) // 10)
        own = words(rng, rng.randint(0, 50)) + (edited(rng, items[k], e) if i % 2 else []) + words(rng, rng.randint(0, 50))
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w + rng.choice(["", ".", ","]) for w in own)))
        edits[i] = (k, e) if i % 2 else None
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(99, None), (98, "..!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_of(spark, rows), bench).collect()}
    letters = {i: re.findall(r"[a-z]+", t.lower()) for i, t in rows}
    truth = {(i, k): distance(w, letters[i]) for i in letters for k, w in enumerate(items) if len(set(w) & set(letters[i])) > len(w) // 2}
    truth = {p: d for p, d in truth.items() if d <= int(0.2 * len(items[p[1]]))}
    assert set(got) <= set(truth)
    assert all(got[p].distance >= d for p, d in truth.items() if p in got)
    planted = {(i, e[0]) for i, e in edits.items() if e}
    assert {(i, e[0]) for i, e in edits.items() if e and e[1] == 0} <= set(got)
    assert len(planted & set(got)) >= 0.95 * len(planted)
    clean = {r.doc_id for r in decontaminate.decontaminate(docs_of(spark, rows), bench).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in got}


def test_sampling_recall():
    """Of items with a tenth of their words edited at least nine in ten share a key."""
    rng = random.Random(5)
    items = [words(rng, n) for n in (15, 25, 40, 58) for _ in range(50)]

    def hashed(w):
        raw, bounds = string_buffer(pa.array([" ".join(w)]))
        return split_words(raw, bounds, fold=True, symbols="out").hash

    known = decontaminate.Items(list(range(len(items))), [hashed(w) for w in items], decontaminate.Sampling(), 0.2)
    found = 0
    for i, w in enumerate(items):
        text = words(rng, 20) + edited(rng, w, max(1, len(w) // 10)) + words(rng, 20)
        found += any(k == i for _, k in known.candidates(hashed(text)))
    assert found >= 0.9 * len(items)


@pytest.mark.parametrize("where", ["head", "middle", "end", "cut", "spread"])
def test_items_with_a_fifth_of_their_words_edited(where):
    """All are found, wherever the edits stand and however long the item is."""
    rng = random.Random(6)

    def hashed(w):
        raw, bounds = string_buffer(pa.array([" ".join(w)]))
        return split_words(raw, bounds, fold=True, symbols="out").hash

    items = [words(rng, n) for n in (16, 25, 38, 59, 120) for _ in range(30)]
    known = decontaminate.Items(list(range(len(items))), [hashed(w) for w in items], decontaminate.Sampling(), 0.2)
    for i, w in enumerate(items):
        n, k = len(w), len(w) // 5
        low = {"head": 0, "middle": (n - 2 * k) // 2, "end": n - 2 * k}.get(where, 0)
        text = list(w)
        for at in range(0, 5 * k, 5) if where == "spread" else rng.sample(range(low, low + 2 * k), k):
            text[at] = "x" + text[at]
        text = words(rng, 20) + (w[k:] if where == "cut" else text) + words(rng, 20)
        found = decontaminate.matches(hashed(text), known.candidates(hashed(text)), known)
        assert found[i][0] == distance(w, text) <= k


def test_short_items_are_found(spark, rng):
    """Items of one to six words stand verbatim in a document, also as the whole of it."""
    items = [words(rng, n) for n in range(1, 7) for _ in range(20)]
    rows = []
    for i, w in enumerate(items):
        rows += [(2 * i, " ".join(["0", *w, "0"])), (2 * i + 1, " ".join(w))]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_of(spark, rows), bench).collect() if r.distance == 0}
    assert {(2 * i + k, i) for i in range(len(items)) for k in (0, 1)} <= got


def test_contaminated_hard_rows(spark, hard_docs, no_docs):
    bench = spark.createDataFrame([(1, "the same row twice, id and text"), (1, None)], "item_id long, text string")
    got = decontaminate.contaminated(hard_docs, bench).collect()
    assert [(r.doc_id, r.distance) for r in got] == [(905, 0)] * 2
    rest = decontaminate.decontaminate(hard_docs, bench)
    assert rest.columns == hard_docs.columns and rest.count() == hard_docs.count() - 2
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(hard_docs, bench.limit(0)).count() == hard_docs.count()


def test_edit_distance_within():
    assert decontaminate.edit_distance_within([1, 2, 3], [9, 1, 2, 3, 9], 1) == (0, 1, 4)
    assert decontaminate.edit_distance_within([1, 2, 3], [9, 1, 3, 9], 1) == (1, 1, 3)
    assert decontaminate.edit_distance_within([1, 2, 3], [7, 8, 9], 1) is None
