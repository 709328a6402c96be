"""Quality rules, the prefix trie and the repair of conversations, against plain versions."""

import collections
import hashlib
import itertools
import random
import re
import statistics
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from llm_fixtures import CLASHES, awkward, nothing, prose  # noqa: F401
from namewire.llm import repair, rules, trie

SPACE = r"[\x20\x09-\x0D]+"


# ---- quality rules -----------------------------------------------------------------------

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k: k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(line in lines[:k] for k, line in enumerate(lines)), len(inside))


TEXTS = ["", " \n\t ", "one", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "é 漢字 😀 <b> é 漢字 😀", "\r\na\r\nb\r\na\r\n",
         "a b a c", "a\x1cb", prose(3, 400, 12), "Same line here.\n" * 70]


@pytest.mark.parametrize("limit", [1 << 20, 7])
def test_counts(monkeypatch, limit):
    monkeypatch.setattr(rules.pieces, "__defaults__", (limit,))
    packer = zstandard.ZstdCompressor(level=3)
    for text in TEXTS:
        assert rules.tally(text.encode(), packer)[:5] == plain_counts(text), text


def test_codes_do_not_overflow():
    draw = random.Random(4)
    ids = [draw.randrange(5) for _ in range(300)]
    import numpy as np
    small = rules.repeated_words(np.array(ids), 5)
    assert rules.repeated_words(np.array(ids), 1 << 40) == small  # numbered anew on the way


def plain_verdicts(texts, chunk):
    """Bands and verdicts straight from the definition."""
    packer = zstandard.ZstdCompressor(level=rules.LEVEL)
    parts = {"whole": collections.defaultdict(list), "chunk": collections.defaultdict(list)}

    def ratio(b):
        return len(packer.compress(b)) / len(b)

    def chunks(b):
        return [b[k: k + chunk] for k in range(0, len(b), chunk)]

    for b in set(texts) - {b""}:
        for kind, some in (("whole", [b]), ("chunk", chunks(b))):
            for part in some:
                parts[kind][len(part).bit_length()].append(int(min(ratio(part), 2) * 1000) / 1000)

    def limits(kind, n):
        low, high = rules.outer_band(n)
        values = parts[kind][n] + [min(low + (high - low) * (k + 0.5) / 20, 2.0) for k in range(20)]
        middle = statistics.median_low(values)
        width = max(6 * statistics.median_low(abs(v - middle) for v in values), 0.1 * middle)
        return max(low, middle - width), min(high, middle + width)

    for b in texts:
        if not b:
            yield "empty"
            continue
        low, high = limits("whole", len(b).bit_length())
        out = [0, 0]
        for part in chunks(b):
            least, most = limits("chunk", len(part).bit_length())
            out[0] += len(part) * (ratio(part) < least)
            out[1] += len(part) * (ratio(part) > most)
        yield ("repetitive" if ratio(b) < low else "incompressible" if ratio(b) > high
               else "repetitive chunks" if out[0] > len(b) / 4 else "incompressible chunks" if out[1] > len(b) / 4 else "kept")


def test_verdicts(spark):
    draw = random.Random(8)
    noise = "".join(chr(draw.randrange(33, 127)) + " " * (draw.random() < 0.1) for _ in range(3000))
    texts = [prose(k, 60 + 20 * k) for k in range(60)] + [noise, "again and " * 400, prose(70, 900) + " so it goes" * 300,
                                                         prose(71, 900) + noise, "", None] + [prose(5, 160)] * 9
    found = rules.judge_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), chunk=512)
    got = {r.doc_id: r for r in found.collect()}
    wanted = list(plain_verdicts([(t or "").encode() for t in texts], 512))
    assert [got[k].verdict for k in range(len(texts))] == wanted
    assert {"kept", "repetitive", "incompressible", "empty"} <= set(wanted) and "repetitive chunks" in wanted
    for k, text in enumerate(texts):
        row, counts = got[k], plain_counts(text or "")
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert row.kept == (not row.base_failed and row.verdict == "kept")


def test_rules_on_awkward_rows(awkward, nothing):
    rows = rules.judge_quality(awkward).collect()
    assert len(rows) == awkward.count()
    assert sorted(r.doc_id is None for r in rows).count(True) == 2
    assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert max(r.n_words for r in rows) == 60_001 and all(r.kept for r in rows if r.n_words > 100)
    assert rules.judge_quality(nothing).count() == 0


# ---- prefix trie -------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def crc(text):
    return zlib.crc32(str(text).encode())


def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()  # settles equal turns and roles
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    whole = {c: tuple(own.get(c - c % 5, [])[: crc(c) % 9] + ts[crc(c) % 9:]) for c, ts in own.items()}
    members = collections.defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in convs if whole[c] == path)
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
                    sum(not children[p] for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, longest):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-20, 3 * n), n):
        for turn in range(draw.choice([1, 2, 3, 5, 8, longest])):
            rows.append((conv, draw.choice([turn, turn, turn, 1, None]) if draw.random() < 0.1 else turn,
                         draw.choice(["user", "assistant", None]) if draw.random() < 0.2 else ["user", "assistant"][turn % 2],
                         draw.choice(["é", "b", "cc", "", None]) if draw.random() < 0.5 else "x"))
    return rows + rows[:3] + [(None, 1, "user", "nobody's")]


def trie_of(frame):
    turns = trie.numbered_turns(frame)
    return trie.prefix_trie(trie.crossed(turns), turns.where("position = 1").select("conv_id")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("seed,n,longest", [(1, 40, 13), (2, 25, 70), (3, 12, 1)])
def test_trie(spark, seed, n, longest):
    rows = conversations(seed, n, longest)
    rows = [r for r in rows]
    frame = spark.createDataFrame(rows, TURNS).select("*", *(F.lit(1).alias(c) for c in CLASHES))
    assert sorted((tuple(r) for r in trie_of(frame).collect()), key=str) == plain_trie(rows)


def test_trie_of_copies_and_of_nothing(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 9000, 5) for t in range(3)] + [(7, 0, "user", "x")]
    got = trie_of(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_trie(rows) and max(r.n_convs for r in got) == 1801
    empty = spark.createDataFrame([], TURNS)
    assert trie_of(empty).count() == 0
    # conversations that lose all their turns are members of the root alone
    lost = next(c for c in range(1, 5) if crc(c) % 9 > 0)
    (root,) = trie_of(spark.createDataFrame([(lost, 0, "user", "x")], TURNS)).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_leaves, root.saved_tokens) == (lost, 0, 1, 1, 0)
    assert root.ends_sha256 == hashlib.sha256(str(lost).encode()).hexdigest()


def test_band_of(spark):
    rows = spark.range(0, 40).select("id", trie.band_of("id").alias("band")).collect()
    for r in rows:
        assert r.band == next(k for k in range(9) if r.id <= 1 << k)


# ---- repair of conversations -------------------------------------------------------------

def plain_repair(turns):
    """Best (cost, audit, lines) over all edit sequences; ``turns`` are (role, text, fault)."""
    grammar = re.compile(r"(s?(ua)+)?")
    names = {"u": "user", "a": "assistant"}

    def sequences(k, depth=0):
        puts = ["", "u", "a", "ua", "au"]
        if k == len(turns):
            for put in puts:
                yield 3 * len(put), "I" * len(put), put, [f"{names[c]}:" for c in put]
            return
        role, text, fault = turns[k]
        options = [(4, "D", "", [])]
        if fault not in ("blank", "duplicate"):
            extra = 3 if fault == "truncated" else 0
            options += [(extra, "K", role[:1] or "?", [f"{role}:{text}"]), (3 + extra, "R", "u", [f"user:{text}"]),
                        (3 + extra, "R", "a", [f"assistant:{text}"])]
        for cost, audit, initials, lines in sequences(k + 1):
            for put in puts:
                for price, edit, initial, line in options:
                    yield (3 * len(put) + price + cost, "I" * len(put) + edit + audit, put + initial + initials,
                           [f"{names[c]}:" for c in put] + line + lines)

    best = min((s for s in sequences(0) if grammar.fullmatch(s[2])), key=lambda s: s[:2])
    return best[0], best[1], hashlib.sha256("\n".join(best[3]).encode()).hexdigest()


def plain_plan(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) by conversation, after damage."""
    out, by = {}, collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        by[conv]
        kind = crc(f"{conv}:{' ' if turn is None else turn}") % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, turns in by.items():
        turns.sort()
        seen, marked = set(), []
        for _, _, role, text in turns:
            solid = re.sub(SPACE, "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [t[1] for t in turns if t[0]]
        initials = [m[0][:1] for m in marked]
        counts = collections.Counter(m[2] for m in marked)
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     *plain_repair(marked))
    return out


def repaired(frame):
    plans, turns = repair.repair(frame)
    found = {r.conv_id: r for r in plans.collect()}
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.text_hash(turns).collect()}
    return {c: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(c, repair.EMPTY_HASH))
            for c, r in found.items()}


def test_repair(spark):
    draw = random.Random(6)
    texts = ["Yes.", "No!", "cut", "", None, " \t", "Odd? ", "same.", "same."]
    rows = [(conv, draw.choice([t, t, t, None, 1]), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
             draw.choice(texts)) for conv in range(-5, 60) for t in range(draw.randrange(1, 5))]
    rows += rows[:2] + [(None, 1, "user", "x."), (70, None, None, None)]
    frame = spark.createDataFrame(rows, TURNS).select("*", *(F.lit(1).alias(c) for c in CLASHES))
    assert repaired(repair.damaged(frame)) == plain_plan(rows)
    assert repaired(repair.damaged(spark.createDataFrame([], TURNS))) == {}


def test_letting_go_loses_nothing():
    draw = random.Random(3)
    short, long = repair.Repairer(), repair.Repairer(slack=1 << 40)
    for _ in range(300):
        n = draw.randrange(0, 60)
        weights = draw.choice([(1, 1, 1, 1), (8, 1, 1, 1), (1, 9, 1, 1), (1, 1, 1, 9)])
        for _ in range(n):
            turn = draw.choices("suax", weights)[0], draw.random() < 0.2, draw.random() < draw.choice([0.1, 0.6])
            short.read(*turn)
            long.read(*turn)
        assert short.finish() == long.finish()
    assert len(short.steps) <= repair.REMEMBERED


def test_any_grammar():
    """Three roles in turn; stacks of the parser, not of this library's default."""
    table = repair.Stacks([("C", "T"), ("C", "CT"), ("T", "xyz"), ("T", "xz")])
    for n in range(7):
        for word in itertools.product("xyz", repeat=n):
            stacks = [(0,)]
            for letter in word:
                stacks = [s for old in stacks for s in table.shift(old, letter)]
            assert any(map(table.accepts, stacks)) == bool(re.fullmatch(r"(xyz|xz)+", "".join(word)))


def test_a_very_long_conversation(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat("id", F.lit(".")).alias("text"))
    plans, turns = repair.repair(rows)
    plan = plans.first()
    assert plan.audit == "K" * n and plan.cost == 0 and turns.count() == n
