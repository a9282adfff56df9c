"""Ranked search, exact top-k search and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import lexical, structure, topk

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_plainly(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in held)
    n_terms = sum(sum(c.values()) for _, c in held)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, wanted in asked.items():
        scores = []
        for doc, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // max(n_terms, 1)
            score = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in o for _, o in held) + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1):
            rows.append((item, rank, doc, -score))
    return sorted(rows, key=str)


def random_texts(n, seed, words="the of Äpfel x1 x2 x3 x4 x5 x6 x7 x8 x9 rare1 rare2 naïve".split()):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize(("most", "block"), [(60, 500_000), (1_000_000, 10)])
def test_ranked_search(spark, most, block):
    docs = [(i // 2 if i % 9 == 0 else i, t) for i, t in enumerate(random_texts(150, 1))]
    docs += [(None, docs[3][1]), (None, None), (500, None), (501, ""), (502, "THE, the; Of-x1"), (502, "THE, the; Of-x1")]
    items = list(enumerate(random_texts(12, 2))) + [(90, None), (91, " ,. "), (92, "absent"), (3, "rare1 more"), (None, "x1 rare2")]
    docs_df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, item_id int, score double").repartition(3)
    items_df = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    found = lexical.ranked(docs_df, items_df, 4, most, block).collect()
    assert sorted(map(tuple, found), key=str) == ranked_plainly(docs, items, 4)


def test_best_positions_stop_early():
    """Direct accesses push the best positions on: reading ends before the lists do, with all ties met."""
    import pyarrow as pa

    n = 4000
    rng = np.random.default_rng(5)
    times = rng.integers(1, 3, 2 * n)
    times[: 2 * 12] = 50
    ids = pa.array(range(n), pa.int64())
    shard = lexical.Shard(ids, np.full(n, 100), np.tile([0, 1], n), times, np.arange(n + 1) * 2, np.array([900, 800]), n, 100 * n)
    docs, scores = shard.best(np.array([0, 1]), 10, 1, np.full(2, -1))
    every = np.add.reduceat(shard.impact, np.arange(0, 2 * n, 2))
    kth = np.sort(every)[-10]
    assert set(docs) >= set(np.flatnonzero(every >= kth)) and (every[docs] == scores).all()
    assert len(docs) < n // 10


def test_search_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(docs, items).count() == 0
    assert lexical.ranked(docs.union(spark.createDataFrame([(1, "a")], docs.schema)), items.where("false")).count() == 0


def top_plainly(rows, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in good:
        if i is not None and i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, a in asked.items():
        scores = [(-sum(x * y for x, y in zip(a, v)), i is None, i or 0, i) for i, v in good if i != q]
        out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_exact_top_k(spark, scale):
    rng = random.Random(3)
    rows = [(i, [round(rng.uniform(-1, 1), 1) * scale for _ in range(3)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(50, rows[9][1]), (50, rows[50][1]), (None, rows[7][1]), (None, rows[7][1])]
    rows += [(2000, None), (2050, [1.0, None, 0.0]), (2100, [math.nan, 0.0, 0.0]), (2150, [math.inf, 0.0, 0.0]), (2200, []), (2250, [0.5])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int").repartition(5)
    queries = df.where("vec_id % 50 = 0")
    expected = top_plainly(rows, 5)
    for block in (topk.BLOCK_VALUES, 9):
        assert sorted(map(tuple, topk.top_k(df, queries, 5, block_values=block).collect()), key=str) == expected


def test_top_k_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0"), 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.where("false"), df.where("vec_id = 0"), 5).count() == 0
    assert topk.top_k(df, df.where("false"), 5).count() == 0
    with pytest.raises(ValueError, match="60 bits"):
        topk.top_k(df.select("vec_id", F.array(F.lit(1e14)).alias("embedding")), df, 5)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        inked = re.sub("[\x20\x09-\x0d]+$", "", text)
        first = "blank" if not inked else "duplicate" if (role, text) in seen else "" if inked[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(first)
    return out


def cheapest_plainly(rows):
    """All sequences of edits with up to two insertions at a place, cut where the roles cannot become legal."""
    best = []
    legal_start = re.compile("(s?(ua)*u?)?")

    def go(i, inserted, cost, audit, turns):
        initials = "".join(r[:1] or "?" for r, _ in turns)
        if not legal_start.fullmatch(initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in turns)))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, inserted + 1, cost + 3, audit + "I", [*turns, (role, "")])
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, 0, cost + 4, audit + "D", turns)
            if marks[i] in ("", "truncated"):
                extra = 3 if marks[i] else 0
                go(i + 1, 0, cost + extra, audit + "K", [*turns, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, 0, cost + 3 + extra, audit + "R", [*turns, (new, text)])

    marks = faults(rows)
    go(0, 0, 0, "", [])
    return min(best)


def cheapest_by_strings(rows):
    """Backwards over (cost, letters) pairs, for conversations too long to enumerate."""
    marks = faults(rows)
    follow = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    chosen = {0: "u", 1: "u", 2: "a", 3: "u"}

    def inserted(f):
        for _ in range(3):
            f = {q: min(f[q], (f[follow[q, chosen[q]]][0] + 3, "I" + f[follow[q, chosen[q]]][1])) for q in f}
        return f

    never = (10**9, "")
    f = inserted({0: (0, ""), 1: never, 2: never, 3: (0, "")})
    for (_, role, _), mark in zip(reversed(rows), reversed(marks)):
        g = {}
        for q in f:
            ways = [(f[q][0] + 4, "D" + f[q][1])]
            if mark in ("", "truncated"):
                extra = 3 if mark else 0
                if (q, role[:1]) in follow:
                    to = f[follow[q, role[:1]]]
                    ways.append((to[0] + extra, "K" + to[1]))
                to = f[follow[q, chosen[q]]]
                ways.append((to[0] + 3 + extra, "R" + to[1]))
            g[q] = min(ways)
        f = inserted(g)
    return f[0]


def expected_counts(rows):
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs)


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", ""]
TEXTS = ["Yes.", "No!", "Cut off", "", " \t", "Why? ", "Ünd", "Yes."]


def conversation(rng, n):
    rows = [(rng.choice([None, *range(2 * n)]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_repairs(spark):
    rng = random.Random(11)
    short = {i: conversation(rng, rng.randint(1, 4)) for i in range(150)}
    long = {1000 + i: conversation(rng, n) for i, n in enumerate([63, 64, 65, 128, 200, 300])}
    for i, n in enumerate([90, 200]):
        # Texts of their own, so that nearly all rows stay.
        long[2000 + i] = [(t, rng.choice(ROLES), f"Text {t}{rng.choice(['.', ''])}") for t in range(n)]
    given = [(c, t, r, x, "clash") for c, rows in (short | long).items() for t, r, x in rows]
    given += [(None, 0, None, None, "clash"), (None, 1, "user", "Hi.", "clash"), (None, 2, "assistant", "Ho.", "clash")]
    rng.shuffle(given)
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, fault string")
    got = {r.conv_id: r for r in structure.repairs(df).collect()}
    assert len(got) == len(short) + len(long) + 1
    for conv, rows in short.items():
        cost, audit, turns = cheapest_plainly(rows)
        digest = hashlib.sha256(turns.encode()).hexdigest()
        assert tuple(got[conv])[1:] == (*expected_counts(rows), cost, audit, digest), rows
    for conv, rows in long.items():
        assert tuple(got[conv])[1:8] == (*expected_counts(rows), *cheapest_by_strings(rows))
    assert tuple(got[None])[1:8] == (0, 1, 0, 0, 1, 4, "DKK")
    turns = {}
    for row in structure.repaired_turns(df).orderBy("conv_id", "position").collect():
        turns.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    for conv, row in got.items():
        assert hashlib.sha256("\n".join(turns.get(conv, [])).encode()).hexdigest() == row.repaired_sha256


def test_damage(spark):
    import zlib

    rows = [(c, t) for c in range(60) for t in range(4)] + [(None, 3), (7, None)]
    df = spark.createDataFrame([(c, t, None if c == 9 else "assistant", None if c == 8 else "One. Two! Three?") for c, t in rows], "conv_id long, turn long, role string, text string")
    expected = []
    for c, t in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = " " if c == 8 else "One. Two! Three?"
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else " " if c == 9 else "assistant"
        expected += [(c, t, role, text, fate == 0)] * (2 if fate == 3 else 1)
    assert sorted(map(tuple, structure.damaged(df).collect()), key=str) == sorted(expected, key=str)
    assert structure.repairs(structure.damaged(df)).count() == 61
    assert structure.repairs(df.where("false")).count() == 0


def test_conversation_dropped_whole(spark):
    gone = spark.createDataFrame([(5, 0, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, gone boolean")
    assert [tuple(r) for r in structure.repairs(gone).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
