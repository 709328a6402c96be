import random

import numpy as np
import pytest

from namewire.llm import minhash, neighbours, passages
from namewire.llm.base import components
from llm_fixtures import awkward, labels, nothing, prose  # noqa: F401


def groups(pairs, nodes):
    above = {n: n for n in nodes}

    def top(a):
        while above[a] != a:
            a = above[a]
        return a

    for a, b in pairs:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def edited(text, seed, edits):
    words, draw = text.split(), random.Random(seed)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**9)}"
    return " ".join(words)


def shingle_set(text, size=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[k: k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 9), (20, 21), (21, 20), (30, 30)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


def test_near_duplicates_against_all_pairs(spark):
    # a crowd of edited copies around one text, many of them just below or above the limit
    texts = {0: prose(3)} | {k: edited(prose(3), k, 1 + k % 7) for k in range(1, 60)}
    texts |= {100 + k: prose(100 + k, 20 + k) for k in range(30)} | {200: prose(100, 20).upper(), 201: "a b c", 202: "A  b\tc", 203: "b c"}
    sets = {k: shingle_set(t) for k, t in texts.items()}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(pairs, sets)
    found = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    got = {r.doc_id: r for r in found.collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_duplicates_awkward(awkward, nothing):
    got = minhash.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[k].component_id for k in (1, 2, 6, 7)] == [1, 1, 6, 6]
    assert [(by_id[k].n_shingles, by_id[k].component_id, by_id[k].kept) for k in (3, 4, 5)] == [(0, 3, True), (0, 4, True), (0, 5, True)]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert minhash.near_duplicates(nothing).count() == 0


def test_passages(spark):
    common, short = prose(50, 60), prose(51, 45)
    texts = {k: f"{prose(60 + k, 80)} {common} {prose(80 + k, 70)}" for k in range(6)}
    texts |= {10 + k: f"{prose(300 + k, 80)} {short} {prose(400 + k, 70)}" for k in range(5)}  # too short to count
    texts |= {20: f"{short} {prose(500, 30)}", 21: f"{prose(501, 40)} {short} {prose(500, 30)}"}  # 75 words with one another
    texts |= {30: prose(600, 90), 31: prose(600, 90), 40: prose(700, 200), 41: prose(701, 49), 42: prose(701, 49)}
    found = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert sorted(found) == [0, 1, 2, 3, 4, 5, 20, 21, 30, 31]
    assert all([tuple(s) for s in found[k].spans] == [(80, 140)] and found[k].n_repeated == 60 for k in range(6))
    assert [tuple(s) for s in found[20].spans] == [(0, 75)] and [tuple(s) for s in found[21].spans] == [(40, 115)]
    assert found[30].n_repeated == 90 and found[31].partner == 30


def test_near_passages(spark):
    common = prose(50, 120)
    changed = common.split()
    changed[60] = "other"
    texts = [(1, f"{prose(1, 80)} {common}"), (2, f"{' '.join(changed)} {prose(2, 80)}"), (3, prose(4, 300))]
    found = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.doc_id: r.n_repeated for r in found.collect()} == {1: 119, 2: 119}


def test_passages_beyond_the_centre(spark):
    """b and c share Y Z, the centre shares X Y with c and only Y with b: whichever document is the centre."""
    rows, shared = [], {}
    for case in range(30):
        x, y, z = prose(1000 + case, 10), prose(2000 + case, 40), prose(3000 + case, 10)
        for k, text in enumerate((f"{x} {y}", f"{y} {z}", f"{x} {y} {z}")):
            at = 10 * case + k
            rows.append((at, f"{prose(10_000 + at, 70)} {text} {prose(20_000 + at, 70)}"))
            shared[at] = (50, 50, 60)[k]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_repeated for r in found.collect()} == shared


def test_recall_of_near_passages(spark):
    """Passages of 50 to 70 words with a word replaced, put in or left out, against all pairs of windows."""
    def near(a, b, least=46):
        for n in range(least, least + 12):
            for x, y in ((least, n), (n, least)):
                for i in range(len(a) - x + 1):
                    for j in range(max(0, i - 6), min(len(b) - y, i + 6) + 1):
                        if a[i] == b[j] and a[i + x - 1] == b[j + y - 1]:
                            common = len(set(a[i: i + x]) & set(b[j: j + y]))
                            if 100 * common >= 80 * (x + y - common):
                                return True
        return False

    rows, wanted = [], set()
    for case in range(300):
        draw = random.Random(case)
        words = prose(1000 + case, 50 + case % 21, 10 ** 9).split()
        at, kind, other = draw.randrange(len(words) // 3, 2 * len(words) // 3), case // 21 % 3, list(words)
        other[at: at + (kind != 1)] = [] if kind == 2 else ["edited"]
        texts = [prose(10_000 + case, 60, 10 ** 9).split() + words + prose(20_000 + case, 60, 10 ** 9).split(),
                 prose(30_000 + case, 60, 10 ** 9).split() + other + prose(40_000 + case, 60, 10 ** 9).split()]
        shingled = [[tuple(t[k: k + 5]) for k in range(56, 60 + len(words) + 1)] for t in texts]
        rows += [(2 * case + k, " ".join(t)) for k, t in enumerate(texts)]
        if near(*shingled):
            wanted.add(case)
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id // 2 for r in found}
    print("recall", len(got & wanted), len(wanted), "beyond", len(got - wanted))
    assert got <= wanted and len(wanted) > 200 and len(got) >= 0.98 * len(wanted)


def test_passages_at_further_places_of_the_centre(spark):
    """Every document has a line several times; two share a passage around a later one, or have a passage twice."""
    rows, shared = [], {}
    for case in range(30):
        line, x, y = prose(1000 + case, 40), prose(2000 + case, 8), prose(3000 + case, 8)
        fill = [prose(10_000 + 10 * case + k, 60) for k in range(8)]
        rows += [(10 * case, f"{fill[0]} {line} {fill[1]} {x} {line} {y} {fill[2]}"), (10 * case + 1, f"{fill[3]} {x} {line} {y} {fill[4]}"),
                 (10 * case + 2, f"{fill[5]} {line} {y} {fill[6]} {line} {fill[7]} {x} {line} {y}")]
        shared |= {10 * case: 56, 10 * case + 1: 56, 10 * case + 2: 56}
        whole = f"{line} {x} {y}"
        again = [prose(20_000 + 10 * case + k, 60) for k in range(5)]
        rows += [(10 * case + 5, f"{again[0]} {whole} {again[1]} {whole} {again[2]}"), (10 * case + 6, f"{again[3]} {whole} {again[4]}")]
        if case % 2:  # in both, the passage; in the others, in one document only
            shared |= {10 * case + 5: 112, 10 * case + 6: 56}
        else:
            rows[-1] = (10 * case + 6, f"{again[3]} {again[4]}")
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_repeated for r in found.collect()} == {k: n for k, n in shared.items()}


def test_passages_awkward(awkward, nothing):
    got = sorted((r.doc_id, r.n_words) for r in passages.repeated_passages(awkward).collect())
    assert got == [(1, 120), (2, 120), (2, 120), (6, 60_000), (7, 60_001)]
    assert passages.repeated_passages(nothing).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_against_all_pairs(spark):
    import numpy as np

    draw = np.random.Generator(np.random.PCG64(0))
    centres = draw.normal(size=(12, 16))
    rows = []
    for k in range(900):
        base = centres[k % 12] + draw.normal(size=16) * (0.08 if k % 3 else 0.9)
        rows.append((k, [float(v) for v in base.astype("f4")], k % 2))
    rows += [(2000, rows[5][1], 1), (2001, rows[5][1], 0), (2002, [0.0] * 16, 1), (2003, None, 1), (2004, rows[5][1], None),
             (2005, [float("nan")] * 16, 1), (2006, [1.0, None], 1), (2007, [], 1), (2008, [float("inf"), 1.0], 0)]
    x = {r[0]: np.array(r[1], float) / np.linalg.norm(r[1]) for r in rows if r[0] < 2002}
    label = {r[0]: r[2] for r in rows}
    pairs = [(a, b) for a in x for b in x if a < b and label[a] == label[b] and x[a] @ x[b] >= 0.98]
    want = groups(pairs, label)
    links = {k: sum(k in p for p in pairs) for k in label}
    # small cells, so that shards overlap and clumps are cut into blocks
    found = {r.vec_id: r for r in neighbours.near_duplicates(vectors_of(spark, rows), cell=64).collect()}
    assert all(found[k].n_links <= links[k] for k in links)
    assert sum(r.n_links for r in found.values()) >= 0.97 * sum(links.values())
    assert sum(found[k].component_id == want[k] for k in want) >= 0.97 * len(want)
    assert all(found[k].n_links == 0 and found[k].kept for k in range(2002, 2009))


def test_neighbours_awkward(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in neighbours.near_duplicates(vectors_of(spark, rows)).collect())
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert neighbours.near_duplicates(vectors_of(spark, rows).limit(0)).count() == 0


def test_neighbours_raise_on_low_recall(spark, monkeypatch):
    import pandas as pd

    def blind(cosine):
        return lambda key, rows: pd.DataFrame({"node": rows["node"], "found": 0, "root": rows["node"]})

    rows = [(k, [1.0, k / 1000], 1) for k in range(40)]
    monkeypatch.setattr(neighbours, "_search", blind)
    with pytest.raises(RuntimeError, match="recall 0.000"):
        neighbours.near_duplicates(vectors_of(spark, rows), attempts=2)


def test_neighbours_of_doubles(spark):
    # apart by less than a float can tell, on both sides of the limit
    x = 0.98
    y = (1 - x * x) ** 0.5
    rows = [(1, [1.0, 0.0], 1, "a"), (2, [x + 1e-9, y], 1, "b"), (3, [x - 1e-9, -y], 1, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = {r.vec_id: r.component_id for r in neighbours.near_duplicates(table).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_longest_spans(spark):
    draw = random.Random(3)
    rows = [(draw.randrange(4), *sorted(draw.sample(range(25), 2))) for _ in range(60)]
    got = sorted(tuple(r) for r in passages.longest(spark.createDataFrame(rows, "node long, start int, end int"), ["node"]).collect())
    assert got == sorted({(n, s, e) for n, s, e in rows if not any(
        m == n and t <= s and e <= f and (t, f) != (s, e) for m, t, f in rows)})


def test_passages_count_keys_before_their_nodes_travel(spark, monkeypatch):
    """The exchange of all windows has a key and a number a row; what a text has twice alone is no match."""
    labels = []
    real = passages.stored

    def seen(df, label, *args):
        out = real(df, label, *args)
        labels.append((label, out.columns, out.count()))
        return out

    monkeypatch.setattr(passages, "stored", seen)
    own = prose(1, 70)
    texts = [(1, own + " mid " + own), (2, prose(2, 90)), (3, prose(3, 90))]
    found = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert found == []
    first = [(columns, n) for label, columns, n in labels if label == "keys-again"][0]
    assert first[0] == ["key"] and first[1] > 0
    assert [n for label, _, n in labels if label == "keys"] == [0]


def test_near_looks_up_what_two_texts_share_once():
    """Against the definition, with items that a text has several times."""
    least, percent = 10, 80
    slack = least * (100 - percent) // percent
    some = 0
    for case in range(40):
        draw = random.Random(case)
        b = [draw.randrange(12 + 40 * (case % 3)) for _ in range(60)]
        a = list(b)
        for _ in range(6):
            at = draw.randrange(len(a))
            a[at: at + draw.randrange(2)] = [draw.randrange(50)] * draw.randrange(2)
        a, b = np.array(a, np.uint32), np.array(b, np.uint32)
        pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]
        near, ca, cb = passages.Near(a, b, least, percent), *(np.array(x) for x in zip(*pairs))
        for (i, j), low, high in zip(pairs, *passages.alike_around(a, b, ca, cb)):
            assert (a[low:high] == b[low + j - i: high + j - i]).all() and low <= i < high
            assert low == 0 or low + j - i == 0 or a[low - 1] != b[low + j - i - 1]
            assert high == len(a) or high + j - i == len(b) or a[high] != b[high + j - i]
            reach = least + slack - 1
            first_a, first_b = {}, {}
            for first, text, at in ((first_a, a, i), (first_b, b, j)):
                for k in range(max(0, at - reach), min(len(text), at + reach + 1)):
                    first.setdefault(int(text[k]), k)
            shared = {first_a[k]: first_b[k] for k in first_a.keys() & first_b.keys()}
            wanted = set()
            for start, from_b in shared.items():
                for last, to_b in shared.items():
                    m, n = last + 1 - start, to_b + 1 - from_b
                    if (abs(from_b - start - j + i) <= slack and abs(to_b - last - j + i) <= slack and min(m, n) == least
                            and max(m, n) <= least + slack):
                        inside = sum(start <= x <= last and from_b <= y <= to_b for x, y in shared.items())
                        if 100 * inside >= percent * (m + n - inside):
                            wanted |= {(x, from_b - start, n - m) for x in range(start, last + 1)}
            got = near.around(i, j)
            some += len(got)
            assert {(x, t - s, f - t - e + s) for s, e, t, f in got for x in range(s, e)} >= wanted and bool(got) == bool(wanted)
            assert got == passages.near_windows(a, b, i, j, least, percent)
    assert some > 1000


def test_spans_leave_the_comparison_once(spark, monkeypatch):
    """Two orders of shingles show the same span again; members go through one exchange by their key."""
    found, plans = [], []
    real = passages.stored

    def seen(df, label, *args):
        if label == "keys":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = real(df, label, *args)
        if label == "found":
            found.extend(tuple(r) for r in out.where("a is not null").collect())
        return out

    monkeypatch.setattr(passages, "stored", seen)
    words = prose(5, 70, 10 ** 9).split()
    texts = [(k, " ".join([prose(10 + k, 60), *words[:35], f"edit{k}", *words[35:], prose(20 + k, 60)])) for k in range(6)]
    assert passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).count() == 6
    assert found and len(found) == len(set(found))
    assert plans and all(p.split("Initial Plan")[0].count("hashpartitioning(key") == 1 for p in plans)
