"""Text operators against brute force, on rows with nulls, copies, empty and long texts."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.llm import crf, decontam, graph, mixing, neardup, pii, quality, rules, substring, text, tokens, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(value):
    return WORD.findall(value or "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_words_and_hashes():
    values = ["a bb  ccc\nd", "", None, " x ", "éü a", "q" * 200 + " r", "z"]
    found = text.Words(pa.array(values))
    assert found.array().to_pylist() == [w for v in values for w in words(v)]
    assert found.counts.tolist() == [len(words(v)) for v in values]
    assert len(set(found.hashes().tolist())) == len({w for v in values for w in words(v)})


@pytest.mark.parametrize("width", [None, 12])
def test_substring_matches_brute_force(odd, empty, width):
    k, first = 4, {}
    data = [(r.doc_id, r.text) for r in odd.collect()]
    for d, t in data:
        w = words(t)
        for i in range(len(w) - k + 1):
            first[tuple(w[i : i + k])] = min(first.get(tuple(w[i : i + k]), 2**63), 2**63 - 1 if d is None else d)
    expected = []
    for d, t in data:
        w = words(t)
        keep = [True] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (2**63 - 1 if d is None else d):
                keep[i : i + k] = [False] * k
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        expected.append((d, len(w), len(w) - len(kept), " ".join(kept)))
    assert rows(substring.without_repeats(odd, k, width)) == sorted(expected, key=str)
    assert substring.without_repeats(empty, k).count() == 0
    assert substring.hash_width(1e8) == 8 and substring.hash_width(1e13) == 12


def test_substring_gives_a_row_for_each_of_equal_rows_in_several_slices(spark):
    made = [(1, "a b c d e f"), (8, "z"), (9, "z")]
    for n in range(3):  # slices of different content, each a partition of its own
        made += [(10 + n, "z"), (2, "a b c d e f x"), (None, "a b c d e f y")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(made, 4), "doc_id long, text string")
    single = [(1, 6, 0, "a b c d e f"), *[(n, 1, 0, "z") for n in range(8, 13)]]
    assert rows(substring.without_repeats(docs, 4)) == sorted([*single, *[(2, 7, 6, "x")] * 3, *[(None, 7, 6, "y")] * 3], key=str)


def test_substring_asks_once_for_a_hash_however_often_a_slice_holds_it():
    texts = ["na " * 1_000_000, "na " * 70, "na " * 70, "a b c", "na " * 60]
    ids = pa.array([5, 3, 3, 1, None], pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), pa.array([1, 2, 2, 3, 4], pa.int64())], ["doc_id", "text", "text_key"])
    windows, *asked = substring.split_slice(batch, 50, 7, 8).to_pylist()
    assert [row["entries"] for row in asked] == [1] and substring.runs_of(asked[0]["ids"]).tolist() == [3]
    number = substring.steps_of(windows["numbers"])
    assert len(number) == 1_000_000 - 49 + 3 * 21 - 10 and set(number[: 1_000_000 - 49]) == {0} and set(number[-11:]) == {0}
    assert set(number[1_000_000 - 49 : -11]) == {1} and sum(len(v) for v in windows.values() if isinstance(v, bytes)) < 20_000


def test_substring_with_one_repeated_word_in_many_slices(spark):
    made = [(n, f"w{n} " + "na " * 5000) for n in range(1, 40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(made, 13), "doc_id long, text string")
    expected = [(1, 5001, 0), *[(n, 5001, 5000) for n in range(2, 40)]]
    assert rows(substring.without_repeats(docs, 50).drop("kept_text")) == sorted(expected, key=str)


def test_finer_sketch_keeps_links_and_drops_distant_pairs():
    rng = np.random.default_rng(3)
    for size in (1, 4, 9, 60, 500, 6000):
        close, far = [], []
        for _ in range(60):
            for shared, sets in ((int(np.ceil(size * 6 / 7)), close), (size // 2, far)):
                x = rng.integers(0, 2**64, size, dtype=np.uint64)
                y = np.concatenate([x[:shared], rng.integers(0, 2**64, size - shared, dtype=np.uint64)])
                sets += [np.sort(x), np.sort(y)]
        for sets, linked in ((close, True), (far, False)):
            blobs = pa.array([c.tobytes() for c in sets], pa.binary())
            batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(sets))), blobs], ["class", "codes"])
            made = b"".join(next(neardup.fine_sketches([batch])).column("fine").to_pylist())
            fine = np.frombuffer(made, np.uint8).reshape(len(sets), -1)
            a = np.arange(0, len(sets), 2)
            passed = neardup.within_reach(fine, np.full(len(sets), size), a, a + 1, 75)
            assert passed.all() if linked else size < 60 or not passed.any()


def test_near_duplicates_match_brute_force(spark, odd, empty):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    copies = []
    for n in range(150):  # a cloud of near copies around the threshold
        w = [x if rng.random() > 0.02 else f"e{rng.random()}" for x in base]
        copies.append((100 + n, " ".join(w), "en", None, 0, "", 0, 0.0))
    data = odd.unionByName(spark.createDataFrame(copies, odd.schema))
    found = {r.doc_id: r for r in neardup.near_duplicates(data).collect() if r.doc_id is not None}
    sets = {}
    for r in data.where("doc_id IS NOT NULL").collect():
        w = words((r.text or "").lower())
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {d: r.component_id for d, r in found.items()} == {d: root(d) for d in sets}
    assert all(r.n_shingles == len(sets[d]) and r.kept == (root(d) == d) for d, r in found.items())
    assert neardup.near_duplicates(empty).count() == 0


def test_last_round_runs_after_an_empty_one(spark, monkeypatch):
    # Pairs a1-a2 and b1-b2 are close; of the cross pairs only a2-b2 is a link, and its sketches look the least alike.
    def texts(seed):
        part = lambda name, n: [f"{name}{seed}x{i}" for i in range(n)]
        core = part("c", 600)
        sides = {"a1": ("p", "q", 44), "a2": ("p", "r", 40), "b1": ("s", "t", 44), "b2": ("s", "u", 40)}
        return [" ".join(core + part(both, 60) + part(own, n)) for both, own, n in sides.values()]

    least, cross = 171, ((0, 2), (0, 3), (1, 2), (1, 3))
    for seed in range(200):
        value = texts(seed)
        made = neardup.sketch_slice(pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(value)], ["doc_id", "text"]), 1)
        sketch = [np.frombuffer(x.as_py(), np.uint16) for x in made.column("sketch")]
        *others, link = [int((sketch[a] == sketch[b]).sum()) for a, b in cross]
        if least <= link < min(others):
            break
    names = made.column("class").to_pylist()
    sets = [set(v.split()) for v in value]
    assert [4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) for a, b in cross] == [False, False, False, True]
    leaves = [(n, c, n, 0) for n, c in [(1, names[0]), (1, names[1]), (2, names[2]), (2, names[3]), *[(3, c) for c in names]]]
    monkeypatch.setattr(neardup, "leaves", lambda _: spark.createDataFrame(leaves, "node long, class long, base long, own int"))
    found = neardup.near_duplicates(spark.createDataFrame(list(enumerate(value)), "doc_id long, text string"), 1, 75).collect()
    assert {r.component_id for r in found} == {0}


def test_large_groups_carry_one_node_per_path(spark, monkeypatch):
    """A group that no level divides: its blocks hold each pair once, and what a row carries does not grow with them."""
    monkeypatch.setattr(neardup, "NODE", 20)
    monkeypatch.setattr(neardup, "LEVELS", 2)
    carried = []
    for n in (60, 120):
        core = [f"c{i}" for i in range(300)]
        value = [" ".join([*core, *[f"own{d}x{i}" for i in range(6)]]) for d in range(n)]
        docs = spark.createDataFrame(list(enumerate(value)), "doc_id long, text string")
        made = [neardup.sketch_slice(pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(value)], ["doc_id", "text"]), 1)]
        classes = spark.createDataFrame(pa.Table.from_batches(made)).select("class", F.col("tokens").alias("tokens"))
        met = neardup.leaves(classes).toPandas()
        assert met.groupby("class")["base"].nunique().max() <= 2 * neardup.TREES
        blocks = met[met["node"] != met["base"]]
        assert len(blocks)
        base, group = next(iter(blocks.groupby("base")))
        pairs = Counter()
        for _, leaf in group.groupby("node"):
            several = leaf["own"].nunique() > 1
            for (a, own_a), (b, own_b) in itertools.combinations(sorted(zip(leaf["class"], leaf["own"])), 2):
                pairs[a, b] += not several or own_a != own_b
        size = group["class"].nunique()
        assert len(pairs) == size * (size - 1) // 2 and set(pairs.values()) == {1}
        homes = met.groupby("class")["base"].nunique()
        carried.append(met["class"].map(homes).sum() / len(met))
        assert {r.component_id for r in neardup.near_duplicates(docs, 1, 75).collect()} == {0}
    # Entries carried by a leaf row stay the same when the group doubles.
    assert carried[1] <= carried[0] * 1.2


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(200, 200), (None, 3)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 150)} == {100} and found[200] == 200


def test_rules_on_odd_rows(odd, empty):
    found = rules.apply_policy(rules.ledger(odd), 3).collect()
    for r, source in zip(sorted(found, key=lambda r: str(r.doc_id)), sorted(odd.collect(), key=lambda r: str(r.doc_id)), strict=True):
        if r.doc_id in (3, 4, 5):
            assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
        if r.doc_id == 8:
            assert r.n_repeat_words == 30_000 and source.text
    changed = {(r.version, r.rule): r for r in rules.ablations(rules.ledger(odd)).collect()}
    judged = [r.fail_bits for r in found]
    for (version, rule), r in changed.items():
        policy, bit = rules.mask(rules.POLICIES[version]), rules.mask([rule])
        assert r.kept == sum(not b & policy for b in judged)
        assert r.kept_without == sum(not b & policy & ~bit for b in judged) and r.only == sum(b & policy == bit for b in judged)
    assert rules.ledger(empty).count() == 0 and rules.ablations(rules.ledger(empty)).count() == 0


def test_token_counts_match_the_library(spark, odd, empty):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    parts = ["a", "é", "×", " ", "  ", "\n", "1", "'re", " '", "<|endoftext|>", "!", "日本", " ", "　", "don't", "🙂"]
    extra = [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(3000)]
    data = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    library = Tokenizer.from_file(path)
    expected = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False))) for r in data.collect()]
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    found = tokens.token_counts(data, vocabulary, 5)
    assert rows(found) == sorted([(*e, e[2] > 5) for e in expected], key=str)
    assert tokens.token_counts(empty, vocabulary).count() == 0


def test_patterns_and_secrets(odd, empty):
    found = {r.doc_id: r for r in pii.find(odd, pii.train()).collect()}
    source = {r.doc_id: r.text for r in odd.collect()}[10]
    spans = [s.split(":") for s in found[10].spans.split(",")]
    assert [(k, source[int(a) : int(b)]) for k, a, b in spans] == [
        ("email", "me.too@b-c.example.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (555) 123-4567"), ("secret", "0123456789abcdef01"),
    ]
    assert all(r.spans == "" for d, r in found.items() if d != 10)
    hidden = {r.doc_id: r.text for r in pii.redacted(odd, pii.train()).collect()}
    assert "[EMAIL]" in hidden[10] and "[SECRET]" in hidden[10] and hidden[3] is None
    assert pii.find(empty, pii.train()).count() == 0


def test_patterns_match_plain_regular_expressions():
    rng = random.Random(3)
    alphabet = [*"0123456789" * 2, *" -.@ab+()\né%", "255.", "1.1.1.", "a@b.", "555-"]
    value = "".join(rng.choice(alphabet) for _ in range(60_000))
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    address = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
    card, phone = re.compile(r"[0-9](?:[\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    plain = lambda m: re.sub("[^0-9]", "", m.group())

    def luhn(digits):
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    value += " 4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 123-4567 +12 34 +1234567890123456 6011000990139424 "
    assert list(pii.cards(value)) == [m.span() for m in card.finditer(value) if 16 <= len(plain(m)) <= 19 and luhn(plain(m))]
    assert list(pii.phones(value)) == [m.span() for m in phone.finditer(value) if 8 <= len(plain(m)) <= 15]
    assert len(list(pii.cards(value))) >= 2 and len(list(pii.phones(value))) >= 1
    assert list(pii.emails(value)) == [m.span() for m in email.finditer(value)]
    assert list(pii.ips(value)) == [m.span() for m in address.finditer(value) if all(int(p) <= 255 for p in m.group().split("."))]


def secrets_in(model, sentences):
    column = pa.array([s.replace("[", "").replace("]", "") for s in sentences])
    found = pii.spans_of(column, model)[pii.KINDS.index("secret")]
    return [{(a, b) for d, a, b in found.tolist() if d == i} for i in range(len(sentences))]


def secret_spans(sentence):
    at, spans = 0, set()
    for part in re.split(r"(\[[^]]*\])", sentence):
        if part.startswith("["):
            spans.add((at, at + len(part) - 2))
        at += len(part) - 2 * part.startswith("[")
    return spans


#: Sentences whose words and forms are not in the training table.
HELD_OUT = (
    "config password=[{k}] was set", "export MY_API_KEY=[{m}]", "client_secret: [ghp_{m}] here", "Authorization: Basic [{m}==] sent", "use Bearer [eyJ{m}.eyJ{m}.{m}] now",
    'the token = "[{k}]" leaked', "aws [AKIA{u}] found", "db_password=[{m}] in env", "secret: [{k}] do not share", "access_token=[{k}] expires",
    "commit {h} fixed the bug", "md5 {x} of the file", "color=#ff00aa and width=12", "version=1.2.3-beta4 released", "see https://a.example.com/?token_count=5&page=2 there",
    "GPT4o2024 and H2O and B2B", "uuid 123e4567-e89b-12d3-a456-426614174000 row", "sha256 {x}{x} matches", "build=2024-11-05T10:00:00Z ok", "max_tokens=512 temperature=0.7",
    "the password field is empty", "score=0.93 rank=17", "mail=none phone=none", "ISBN 978-3-16-148410-0 page 12",
)


def test_secrets_on_held_out_sentences():
    rng = np.random.default_rng(99)
    pick = lambda letters, low, high: "".join(rng.choice(list(letters), rng.integers(low, high)))
    mixed_ = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    fill = {
        "k": lambda: pick("0123456789abcdef", 16, 41), "m": lambda: pick(mixed_, 16, 30), "u": lambda: pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 17),
        "h": lambda: pick("0123456789abcdef", 40, 41), "x": lambda: pick("0123456789abcdef", 32, 33),
    }
    sentences = [re.sub(r"\{(\w)\}", lambda m: fill[m[1]](), s) for s in HELD_OUT * 25]
    right = found = wanted = 0
    for got, truth in zip(secrets_in(pii.train(), sentences), map(secret_spans, sentences), strict=True):
        right, found, wanted = right + len(got & truth), found + len(got), wanted + len(truth)
    print(f"secrets: precision {right / found:.3f}, recall {right / wanted:.3f}")
    assert right / found >= 0.9 and right / wanted >= 0.9


def test_secrets_follow_the_table_given():
    table = [(["code", "zz11qq"], [pii.OUTSIDE, pii.SECRET]), (["code", "12"], [pii.OUTSIDE, pii.OUTSIDE]), (["a", "b"], [0, 0])] * 30
    model = pii.train(table)
    assert secrets_in(model, ["code [zz11qq] 12", "password=[0123456789abcdef]"])[0] == {(5, 11)}


def test_viterbi_matches_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, states = int(rng.integers(1, 6)), 3
        score, enter, moves = rng.normal(size=(n, states)), rng.normal(size=states), rng.normal(size=(states, states))
        total = lambda p: enter[p[0]] + sum(score[i, s] for i, s in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        best = max(itertools.product(range(states), repeat=n), key=total)
        found = crf.viterbi(score, np.array([n]), enter[None, :], moves, np.zeros((1, states)))
        assert tuple(found.tolist()) == best


def test_marginals_match_enumeration():
    rng = np.random.default_rng(4)
    for size in (0.5, 3, 8, 15):
        for _ in range(10):
            lengths = rng.integers(1, 9, int(rng.integers(1, 6)))
            odds, moves = rng.uniform(-2 * size, 2 * size, lengths.sum()), rng.uniform(-size, size, (3, 2))
            first, expected = np.zeros(len(odds), bool), []
            for at, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
                first[at] = True
                paths = list(itertools.product((0, 1), repeat=int(n)))
                total = [moves[2, p[0]] + odds[at : at + n] @ p + sum(moves[a, b] for a, b in itertools.pairwise(p)) for p in paths]
                weight = np.exp(np.array(total) - max(total))
                expected += list((weight[:, None] * np.array(paths)).sum(axis=0) / weight.sum())
            assert np.allclose(crf.chances(odds, first, moves, 5), expected, atol=1e-9)


def test_marginals_do_not_depend_on_chunks():
    """One long text whose field hardly forgets: a chunk must know what entered it."""
    rng = np.random.default_rng(8)
    odds, moves = rng.normal(0, 0.01, 3000), np.array([[3.0, -3.0], [-3.0, 3.0], [0.0, 2.0]])
    odds[0] = 6
    first = np.arange(3000) == 0
    whole = crf.chances(odds, first, moves, 3000)
    assert whole[300] > 0.6 and np.allclose(crf.chances(odds, first, moves, 16), whole, atol=1e-9)


def test_classifiers_on_odd_rows(odd, empty, labels):
    for module in (toxicity, quality):
        model = module.train(odd, labels)
        scores = module.scored(odd, model)
        assert scores.count() == odd.count() and scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert module.scored(empty, module.train(empty, labels.limit(0))).count() == 0


def test_leaks_match_brute_force(spark, odd, empty):
    rng = random.Random(5)
    letters = "abcdefghijklmnop"
    items = [(i, " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(30))) for i in range(12)]
    docs, expected = [], set()
    for n in range(60):
        i, item = rng.choice(items)
        value = list(item)
        for _ in range(n % 12):
            value[rng.randrange(len(value))] = rng.choice(letters)
        filler = " ".join("".join(rng.choices(letters, k=5)) for _ in range(40))
        docs.append((n, f"{filler} {''.join(value).upper()} {filler}"))
    for d, value in docs:
        for i, item in items:
            if decontam.search(item, value.lower())[0] <= int(0.08 * len(item)):
                expected.add((d, i))
    data = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (None, None), (50, ""), (51, "short")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(data, bench).collect()}
    assert found <= expected and len(found) >= 0.95 * len(expected)
    assert decontam.leaks(odd, bench).count() == 0 and decontam.leaks(empty, bench).count() == 0
    assert decontam.leaks(data, bench.limit(0)).count() == 0 and decontam.clean(odd, bench).count() == odd.count()


def test_long_items_are_searched_by_parts(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    long, other = (" ".join(word() for _ in range(n)) for n in (18_000, 2_000))
    near, far = list(long), list(other)
    for value, share in ((near, 0.05), (far, 0.2)):
        for at in rng.sample(range(len(value)), int(share * len(value))):
            value[at] = "z"
    filler = " ".join(word() for _ in range(300))
    docs = [(1, f"{filler} {long} {filler}"), (2, f"{filler} {''.join(near)}"), (3, f"{''.join(far)} {filler}"), (4, f"x {other}"), (5, long[: len(long) // 2])]
    bench = spark.createDataFrame([(1, long), (2, other), (3, long), (None, other)], "item_id long, text string")
    assert len(long) > 100_000 and len(decontam.parts_of(long, 0.08)) == -(-len(long) // decontam.PART)
    found = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (1, 3), (2, 1), (2, 3), (4, 2), (4, None)} and len(found) == 6
    assert {r.distance for r in found if r.doc_id != 2} == {0}
    assert all(0.04 * len(long) < r.distance <= 0.05 * len(long) for r in found if r.doc_id == 2)


def test_windows_to_embed_match_a_plain_count():
    """Windows start where enough q-grams of an item lie in place, give or take its edits."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    items = [" ".join(word() for _ in range(n)) for n in (12, 20, 20, 60)] + ["ab " * 20 + "c", "é" * 20 + " " + "abcd" * 8]
    texts = []
    for n in range(40):
        value = list(rng.choice(items))
        for _ in range(n % 7):
            value[rng.randrange(len(value))] = rng.choice(["", "x", " ", "yy"])
        fill = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(2)]
        texts.append(("" if n % 5 == 0 else " ").join([fill[0], "".join(value), fill[1]]))
    texts += ["", None, items[0] * 3]
    index = decontam.build(pa.table({"item_key": [str(i) for i in range(len(items))], "text": items}), 0.08, 24)
    data, starts, offsets = decontam.plain(pa.array(texts))
    codes = decontam.gram_codes(data)
    found = set(zip(*(x.tolist() for x in decontam.candidates(index, codes, starts, offsets)), strict=True))
    certain, possible = set(), set()
    for begin, end in itertools.pairwise(offsets.tolist()):
        for part, size in enumerate(index.sizes.tolist()):
            mine = index.posting[1] == part
            places = [(p, p - int(q)) for p in range(begin, min(end, len(codes))) for q in index.posting[2][mine & (index.posting[0] == codes[p])]]
            edits, least = int(index.edits[part]), int(index.least[part])
            own = set(starts[(starts >= begin) & (starts < end)].tolist())
            for s in own | {max(shift, begin) for _, shift in places}:
                held = [p for p, shift in places if abs(shift - s) <= edits]
                if len(held) >= least and s + size - edits <= end:
                    possible.add((s, size))
                    if s in own and sum(p >= s for p in held) >= least:
                        certain.add((s, size))
    assert len(certain) > 30 and certain <= found <= possible


def test_windows_are_embedded_in_bounded_batches(monkeypatch):
    asked, keys_of = [], decontam.keys_of
    monkeypatch.setattr(decontam, "keys_of", lambda data, start, size: asked.append(len(size) * size.max()) or keys_of(data, start, size))
    rng = np.random.default_rng(2)
    data, size = rng.integers(97, 123, 20_000).astype(np.uint8), rng.permutation(np.repeat([40, 300, 2000, 2600], [900, 300, 200, 100]))
    start = rng.integers(0, 17_000, len(size))
    keys = decontam.keys_by_size(data, start, size)
    assert max(asked) <= decontam.WINDOW_BYTES and len(asked) < 12
    one = rng.permutation(len(size))[:50]
    assert (keys[one] == np.concatenate([keys_of(data, start[[i]], size[[i]]) for i in one])).all()


def test_leaks_without_spaces_and_short_items(spark):
    rng = random.Random(11)
    runs = ["".join(rng.choices("abcdefghijklmnop", k=60)) for _ in range(20)]
    runs += ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(60)) for _ in range(20)]
    docs = [(n, "".join(rng.choices("qrstuvwxyz", k=700)) + v + "".join(rng.choices("qrstuvwxyz", k=700))) for n, v in enumerate(runs)]
    docs += [(100, "so Paris, the capital"), (101, "comparison, parisian, eparis"), (102, "eins 東京都庁舎 zwei"), (103, "a fine old town hal here"), (104, "")]
    docs += [(105, "".join(c if n % 6 else "\u9fff" for n, c in enumerate(runs[20])))]  # a sixth of the characters is another
    items = [*enumerate(runs), (100, "paris"), (102, "京都庁"), (103, "fine old town hall"), (104, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found == {(n, n): 0 for n in range(40)} | {(100, 100): 0, (102, 102): 0, (103, 103): 1}


def test_mixing_meets_the_margins(spark, odd, empty):
    rng = random.Random(2)
    made = [(i, "w " * rng.randint(100, 120), rng.choice(["en", "en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "s1", "s2", None])) for i in range(6000)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    targets = {"en": 0.5, "de": 0.4}
    topics = {"even": 0.7, "odd": 0.3}
    topic = F.when(F.col("doc_id") % 4 == 0, "odd").otherwise("even")
    out = mixing.mixed(docs, targets, topics, rate=0.3, flatten=0.5, topic=topic)
    weight = F.sum(F.col("n_tokens") * F.col("sample_weight"))
    total = out.agg(weight).first()[0]
    share = lambda column: {r[0]: r[1] / total for r in out.groupBy(column).agg(weight).collect()}
    assert share("lang") == pytest.approx({"en": 0.5, "de": 0.4, None: 0.1}, abs=0.04)
    assert share("topic") == pytest.approx(topics, abs=0.04)
    assert total == pytest.approx(0.3 * sum(len(words(m[1])) for m in made), rel=0.06)
    assert mixing.mixed(odd).count() <= odd.count() and mixing.mixed(empty).count() == 0
    clashing = docs.withColumns({"_mix_source": F.lit(1), "_MIX_TOKENS": F.lit(1), "Topic": F.lit("x")})
    same = mixing.mixed(clashing, targets, topics, rate=0.3, flatten=0.5, topic=topic)
    assert rows(same.select("doc_id", "topic", "sample_weight")) == rows(out.select("doc_id", "topic", "sample_weight"))
    assert "Topic" not in same.columns and {"_mix_source", "_MIX_TOKENS"} <= set(same.columns)


def test_contradicting_margins_are_reported(spark):
    docs = spark.createDataFrame([(i, "w " * 100, lang, lang) for i in range(200) for lang in ("en", "de")], "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="contradict"):
        mixing.mixed(docs, {"en": 0.9, "de": 0.1}, {"all": 1.0}, topic=F.lit("all"))


def test_raking_matches_a_plain_loop(spark):
    rng = np.random.default_rng(8)
    cells = rng.integers(1, 500, (5, 3, 3)).astype(float)
    cells[:, 2, :] = cells[:, :, 2] = 0
    sources = spark.createDataFrame([(f"s{i}", cells[i].ravel().tolist()) for i in range(5)], "source string, tokens array<double>")
    languages, topics = {"a": 0.7, "b": 0.3}, {"x": 0.2, "y": 0.8}
    by_l, by_t, log = mixing.rake(sources, languages, topics, 0.5)
    fitted, total = cells.copy(), cells.sum()
    own = np.sqrt(cells.sum(axis=(1, 2)))
    for _ in range(2000):
        fitted *= (np.array([0.7, 0.3, 0]) * total / np.maximum(fitted.sum(axis=(0, 2)), 1e-300))[None, :, None]
        fitted *= (np.array([0.2, 0.8, 0]) * total / np.maximum(fitted.sum(axis=(0, 1)), 1e-300))[None, None, :]
        fitted *= (own / own.sum() * total / fitted.sum(axis=(1, 2)))[:, None, None]
    factor = sources.select("source", mixing.source_factor(by_l, by_t, log[-1]["total"], log[-1]["powers"], 0.5).alias("f")).collect()
    mine = np.array([r.f for r in sorted(factor)])[:, None, None] * np.outer(by_l, by_t) * cells
    assert mine == pytest.approx(fitted, rel=1e-3, abs=1e-6)


def test_clashing_columns_do_not_stop_the_stages(odd):
    clashing = odd.withColumns({"kept_id": F.lit(1), "Leaking_ID": F.lit("x")})
    assert {"kept_id", "Leaking_ID"} <= set(neardup.representatives(clashing).columns)
    items = odd.where("doc_id = 1").select(F.col("doc_id").alias("item_id"), "text")
    assert decontam.clean(clashing, items).where("doc_id IN (1, 2)").count() == 0


def test_warc_round_trip_and_links(spark):
    pages = [(1, "http://a/", "<title>T &amp; u</title><p>One<br>two &lt;3<script>x('</p>')</script></p>"), (2, None, None), (None, "http://b/", ""), (2, None, None)]
    responses = warc.responses_of(spark.createDataFrame(pages, "page_id long, url string, html string"), "2024-01-01T00:00:00Z")
    gzip = spark.createDataFrame([("urn:uuid:1", "response", b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n\x1f\x8b"), ("urn:uuid:2", "response", None), (None, "request", b"x")], "record_id string, warc_type string, block binary")
    both = responses.unionByName(gzip, allowMissingColumns=True)
    made = warc.derivatives(both)
    records = made.collect()
    assert sum(r.warc_type == "metadata" for r in records) == 6 and sum(r.warc_type == "conversion" for r in records) == 5
    first = responses.where("target_uri = 'http://a/'").first()
    own = {r.warc_type: r for r in records if r.refers_to == first.record_id}
    assert bytes(own["conversion"].block) == b"One\ntwo <3"
    fields = bytes(own["metadata"].block).decode()
    assert first.block_digest in fields and first.payload_digest in fields and own["conversion"].record_id in fields
    assert "http-header-Content-Type: text/html; charset=utf-8\r\n" in fields and "title: T & u\r\n" in fields
    assert all(r.block_digest == "sha256:" + hashlib.sha256(bytes(r.block)).hexdigest() for r in records)
    assert rows(warc.deserialized(warc.serialized(made))) == rows(made.select(*warc.FIELDS))
    assert warc.derivatives(both.where("false")).count() == 0


def test_warc_character_sets_and_entities(spark):
    page = "<p>&#233;&#x2014;&eacute; &copy; &amp;lt; &#xD800; &#99999999; &#; 5 &lt; 6 &#38;amp;</p>" + "<b>long</b> " * 50_000
    made = [
        (1, "utf-16", "héllo“".encode("utf-16")), (2, "utf-16", b"\xff\xfe\x00\xd8a"), (3, "shift_jis", "日本".encode("shift_jis")),
        (4, "no-such", b"x"), (5, "windows-1252", b"\x93q\x94"), (6, "utf-8", b"\xe9"), (7, "utf-8", page.encode()), (8, "", None),
    ]
    head = lambda charset: f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\n\r\n".encode()
    rows_ = [(f"urn:{i}", "response", head(c) + (b or b""), "clash", "clash", True) for i, c, b in made]
    df = spark.createDataFrame(rows_, "record_id string, warc_type string, block binary, html string, page string, decoded boolean")
    for name in warc.FIELDS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    found = warc.derivatives(df).collect()
    texts = {r.refers_to: bytes(r.block).decode() for r in found if r.warc_type == "conversion"}
    states = {r.refers_to: re.search("conversion-status: (.*)\r", bytes(r.block).decode())[1] for r in found if r.warc_type == "metadata"}
    assert {k: v for k, v in texts.items() if k != "urn:7"} == {"urn:1": "héllo“", "urn:3": "日本", "urn:5": "“q”", "urn:6": "é", "urn:8": ""}
    assert states == {f"urn:{i}": "undecodable" if i in (2, 4) else "converted" for i in range(1, 9)}
    assert texts["urn:7"].startswith("é—é © &lt; &#xD800; &#99999999; &#; 5 < 6 &amp;\nlong long")
