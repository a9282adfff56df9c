"""Personal data in texts: fixed patterns, and secrets found by a conditional random field.

Patterns find emails, addresses, cards and phone numbers. A three-state field (outside, cue,
secret) over word-shape features adds credentials: keys, tokens and passwords. It is trained at the driver on
a small table of labelled sentences, the caller's or the one made here, and decoded by Viterbi for all sequences of a slice at
once. The table made here has as many sentences without a secret as with one, among them ids, digests, versions, colours and addresses
that look like one. A sequence is a word that is not plain (it has a digit or a sign, or is a known cue) with
up to two words on either side; further plain words cannot be part of a secret.

Null and empty texts have no spans. A found secret that overlaps a pattern's span is left out.
Offsets count code points, ends are exclusive. Every input row gives a row; repeated rows
repeat their result; other columns are not read (``redacted`` passes them on).
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import crf
from eventloom.llm.text import Words, by_slices, tuned

KINDS = ("email", "ip", "card", "phone", "secret")
OUTSIDE, CUE, SECRET = range(3)
DIMS = 1 << 14
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot start inside a run of digits unless it can at the start of the run.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]")


def run_start(text: str, low: int, end: int) -> int:
    """Where the run of local-part characters before ``end`` begins, not before ``low``."""
    size = 64
    while True:
        begin = max(low, end - size)
        rest = len(text[begin:end].rstrip(LOCAL))
        if rest or begin == low:
            return begin + rest
        size *= 4


def emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        tail = EMAIL_TAIL.match(text, at)
        begin = run_start(text, low, at) if tail else at
        if begin < at:
            low = tail.end()
            yield begin, low
        at = text.find("@", max(at + 1, low))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


PATTERNS = (emails, ips, cards, phones)

# Labelled sentences: {k} is a hexadecimal key, {u} an upper-case one, {m} a mixed one, {n} a
# number, {w} a plain word. Words between < > are cues, words between [ ] are secrets.
SENTENCES = (
    "{w} {w} [password={k}] {w} {w}", "{w} [passwd={m}] {w}", "{w} {w}. [pwd={m}] {w}", "{w} [secret={k}] {w}",
    "{w} [api_key={k}] {w} {w}", "{w} [apikey={m}] {w}", "{w} [access_token={k}] {w}", "[auth_token={m}] {w} {w}",
    '{w} <token> <=> ["{k}"] {w} {w}', '{w} <password> <=> ["{m}"] {w}', '<api_key> <=> ["{k}"] {w}', '{w} <secret> <=> ["{m}"]',
    "{w} <password:> [{m}] {w}", "{w} <token:> [{k}] {w}", "<api_key:> [{u}] {w}", "<secret:> [{k}] {w} {w}", "{w} <Bearer> [{m}] {w}",
    "{w} {w} [AKIA{u}] {w} {w}", "[AKIA{u}] {w} {w}", "{w} {w}, [AKIA{u}].", "{w} [AKIA{u}] {w}", '{w} <key> <=> ["AKIA{u}"] {w}',
    "{w} {w} {n} {w} {w}", "{w} Version 2.0. {w} {w}", "{w} License, version 3. {w}", "CC BY-NC 4.0. {w} {w}", "{w} {n}.{n}.{n}.{n} {w}",
    "{w} 4{n}{n}{n}{n}{n}{n}{n} {w}", "{w} +1 ({n}) 555-{n} {w}", "{w} {w}.{n}@mail{n}.example.com {w}", "{w} = {w} {w}", "{w} = {n} {w}",
    '{w} = "{w}" {w}', "{w}: {n} {w}", "{w}={n} {w} {w}", "{w} | {w} | {w}", "{w}*** {w}### {w}$$$ {w}&&&", "{w}!! {w}!! {w}!!", "{w} token {w} {w}",
    "the password {w} {w}", "{w} key {w} secret {w}", "{w} {n}-{n}-{n} {w}", "{w} {n}:{n} {w}", "{w} {n}% {w}", "{w} x{n} {w}{n} {w}", "{w} page={n} {w}",
    "{w} https://{w}.example.com/{w}/{n} {w}", "{w} #{n} {w}", "{w}, {w}; {w}: {w}", '{w} "{w} {w}" {w}', "{w} ({n}) {w}", "{w} mode={w} {w}",
    "{w} <client_secret:> [{m}] {w}", "<private_key:> [ghp_{m}]", "{w} [client_secret={m}] {w}", "{w} [db_password={k}] {w}", "[SECRET_KEY={m}] {w}",
    "<Authorization:> <Basic> [{m}==] {w}", "{w} <Basic> [{m}=] {w}", "<Authorization:> <Bearer> [eyJ{m}.eyJ{m}.{m}]", "{w} <Bearer> [eyJ{m}.{m}.{m}] {w}",
    "{w} [API_TOKEN={k}]", "{w} <password:> [ghp_{m}] {w}", "{w} <auth_token:> [{m}] {w}", '{w} <client_secret> <=> ["{m}"] {w}',
    "commit {k} {w} {w}", "{w} commit {k}", "{w} revision {k}. {w}", "md5 {k} {w}", "{w} sha1: {k} {w}", "sha256 {k}{k} {w}", "{w} checksum {k} {w}", "{w} digest: {k}",
    "{w} id {k} {w}", "{w} {k} {w}", "{k} {w} {w}", "{w} uuid {k}-{n}-{n}-{k} {w}", "{w} {n}e{n}-{n}-{n} {w}", "{w} hash={k} {w}", "{w} etag={k} {w}", "{w} commit={k}",
    "{w} color=#{n}{w} {w}", "{w} color=#ff00aa {w}", "{w} width={n} height={n}", "{w} version={n}.{n}.{n}-{w}{n} {w}", "{w} version=v{n}.{n} {w}", "{w} build={n}-{n}-{n}T{n}:{n}:{n}Z {w}",
    "{w} https://{w}.example.com/?token_count={n} {w}", "{w} https://{w}.example.com/{w}?key={w}&page={n}", "{w} http://{w}.example.org/?session={n}", "{w} max_tokens={n} {w}",
    "{w} password_length={n} {w}", "{w} token_count={n} {w}", "{w} n_keys={n}", "{w} score={n}.{n} {w}", "{w} {w}={w} {w}={w}", "{w} lang={w} {w}", "GPT{n}o{n} {w}", "{w} H{n}O {w} B{n}B {w}",
    "{w} {w}{n}{w}{n} {w}", "{w} ISBN {n}-{n}-{n}-{n} {w}", "{w} ticket ABC-{n} {w}", "the password {w} {w} {w}", "{w} password: {w} {w}", "{w} token: {w} {w}", "{w} secret: {w} {w}",
)


def labelled(repeats: int = 12) -> list[tuple[list[str], list[int]]]:
    """The training table: every sentence with several fillings, its words and their states."""
    rng = np.random.default_rng(5)
    pick = lambda letters, low, high: "".join(rng.choice(list(letters), rng.integers(low, high)))
    fill = {
        "k": lambda: pick("0123456789abcdef", 16, 41),
        "u": lambda: pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 17),
        "m": lambda: pick("abcdefghjkmnpqrstuvwxyzABCDEFGHKLMNPQR23456789", 12, 28),
        "n": lambda: pick("0123456789", 1, 4),
        "w": lambda: pick("abcdeghilmnorstu", 2, 9),
    }
    made = []
    for sentence in SENTENCES * repeats:
        words, states = [], []
        for word in sentence.split():
            state = SECRET if word[0] == "[" else CUE if word[0] == "<" else OUTSIDE
            words.append(re.sub(r"\{(\w)\}", lambda m: fill[m[1]](), word.strip("[]<>,.") if state == SECRET else word.strip("<>") if state == CUE else word))
            states.append(state)
        made.append((words, states))
    return made


def shape(word: str) -> str:
    collapsed = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "9", word[:200])))
    return re.sub(r"(a9|9a){2,}a?", "h", re.sub(r"(A9|9A){2,}A?", "H", collapsed))[:24]


def parted(word: str) -> tuple[str, str, str]:
    """Name, sign and value of a word like ``name=value``; signs at the end alone are padding of one whole value."""
    name, sign, value = word.partition("=")
    return (name, sign, value) if value.strip("=\"'.,;:)") or not value else (word, "", "")


def shape_features(word: str) -> list[int]:
    """Hashed features of a word from its shape, length, ends and key before a sign."""
    body = word.strip("\"'.,;()*#$%&!")
    name, sign, value = parted(body)
    core = value if sign else body
    found = [
        "s" + shape(body),
        "v" + shape(core),
        f"l{min(len(core), 48) // 4}",
        f"d{sum(map(str.isdigit, core[:64])) * 4 // max(len(core[:64]), 1)}",
        "n" + (name.lower()[:16] if sign else ""),
        "q" + (re.split(r"[^a-z]+", name.lower()[-24:])[-1] if sign else ""),
        "r" + (re.split(r"[^a-z]+", name.lower()[-24:])[-1] if sign else "") + str(min(len(value), 24) // 8),
        f"u{'://' in word[:12]}{len(name) > 24}",
        "p" + word[:4],
        f"e{bool(sign)}{word[:1] in chr(34) + chr(39)}{word[-1:] == ':'}",
        "w" + word.lower() if len(word) <= 12 and not re.search("[0-9]", word) else "long",
        f"h{bool(re.fullmatch('[0-9a-f]{12,}', core[:200]))}{bool(re.fullmatch('[0-9]+', core[:200]))}",
    ]
    return [zlib.crc32(f.encode()) % DIMS for f in found]


PLAIN = [zlib.crc32(b"plain") % DIMS]


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray
    cues: list[str]


#: Bytes a plain word does not have.
SIGNS = r"""[0-9=:_"'@/+]"""


def is_plain(word: str, cues: set[str]) -> bool:
    return word not in cues and not re.search(SIGNS, word)


def train(table: list[tuple[list[str], list[int]]] | None = None) -> Model:
    """A field fitted to labelled sentences, (words, states) each; a few thousand at most, as the driver fits it."""
    table = labelled() if table is None else table
    cues = sorted({w for words, states in table for w, s in zip(words, states, strict=True) if s == CUE} | {"="})
    features, counts, lengths, labels = [], [], [], []
    for words, states in table:
        for word in words:
            own = PLAIN if is_plain(word, set(cues)) else shape_features(word)
            features += own
            counts.append(len(own))
        lengths.append(len(words))
        labels += states
    arrays = [np.array(x) for x in (features, counts, lengths, labels)]
    weights, moves = crf.fit(*arrays, 3, DIMS, steps=80)
    return Model(weights, moves, cues)


def secrets(words: Words, model: Model) -> np.ndarray:
    """Numbers of the words that Viterbi decoding calls secret."""
    coded = words.array().dictionary_encode()
    table, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    special = pc.or_(pc.match_substring_regex(table, SIGNS), pc.is_in(table, pa.array(model.cues, table.type))).to_numpy(zero_copy_only=False)
    if not special.any():
        return np.zeros(0, np.int64)
    score = np.tile(model.weights[PLAIN].sum(axis=0), (len(table), 1))
    for i in np.flatnonzero(special):
        score[i] = model.weights[shape_features(table[int(i)].as_py())].sum(axis=0)
    at = np.flatnonzero(special[index])
    near = np.zeros(len(words), bool)
    doc = np.searchsorted(words.first, at, "right") - 1
    for step in (-2, -1, 0, 1, 2):
        moved = at + step
        near[moved[(moved >= words.first[doc]) & (moved < words.first[doc + 1])]] = True
    token = np.flatnonzero(near)
    owner = np.searchsorted(words.first, token, "right") - 1
    begin = np.flatnonzero(np.concatenate([[True], (np.diff(token) > 1) | (np.diff(owner) > 0)]))
    lengths = np.diff(np.append(begin, len(token)))
    enter = np.tile(model.moves[3], (len(lengths), 1))
    states = crf.viterbi(score[index[token]], lengths, enter, model.moves[:3], np.zeros_like(enter))
    return token[states == SECRET]


def spans_of(column, model: Model) -> list[np.ndarray]:
    """Per kind the (text, start, stop) of all spans of a slice, sorted; offsets in code points."""
    texts = pc.fill_null(column, "").to_pylist()
    # No pattern can match a line break, so texts joined by one are searched at once.
    whole = "\n".join(texts)
    base = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    found = []
    for pattern in PATTERNS:
        spans = np.array(list(pattern(whole)), np.int64).reshape(-1, 2)
        doc = np.searchsorted(base, spans[:, 0], "right") - 1
        found.append(np.column_stack([doc, spans - base[doc][:, None]]))
    words = Words(column)
    at = secrets(words, model)
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    doc = np.searchsorted(words.first, at, "right") - 1
    rows = []
    taken = sorted((int(d), int(a), int(b)) for part in found for d, a, b in part)
    heads = [t[:2] for t in taken]
    for d, a, b in zip(doc.tolist(), words.start[at].tolist(), words.stop[at].tolist(), strict=True):
        word = words.data[a:b].tobytes().decode("utf-8", "replace")
        _, sign, value = parted(word)
        kept = value if sign and value else word
        lead = len(word) - len(kept)
        lead += len(kept) - len(kept.lstrip("\"'(,;:"))
        stop = lead + len(word[lead:].rstrip("\"').,;:*#$%&!"))
        begin = int(points[a] - points[words.offsets[d]])
        begin, stop = begin + lead, begin + stop
        if stop <= begin:
            continue
        i = bisect_left(heads, (d, stop))
        clash = any(t[0] == d and t[2] > begin and t[1] < stop for t in taken[max(0, i - 8) : i])
        if not clash:
            rows.append((d, begin, stop))
    found.append(np.array(rows, np.int64).reshape(-1, 3))
    return found


def named(found: list[np.ndarray], n: int, kinds) -> list[str]:
    parts: list[list[str]] = [[] for _ in range(n)]
    for kind in kinds:
        for d, a, b in found[KINDS.index(kind)].tolist():
            parts[d].append(f"{kind}:{a}:{b}")
    return [",".join(p) for p in parts]


def find_slice(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
    found, n = spans_of(batch.column("text"), model), batch.num_rows
    counts = [pa.array(np.bincount(f[:, 0], minlength=n).astype(np.int64)) for f in found]
    columns = [batch.column("doc_id"), *counts, pa.array(named(found, n, KINDS[:4])), pa.array(named(found, n, KINDS))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, counts per kind, ``base`` (spans of the patterns) and ``spans`` (all) as
    ``kind:start:end`` in the order of kinds and starts."""
    tuned(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape_ = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return by_slices(rows, lambda part: find_slice(part, model), shape_)


def redact_slice(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    by_doc: dict[int, list] = {}
    for kind, part in zip(KINDS, spans_of(batch.column("text"), model), strict=True):
        for d, a, b in part.tolist():
            by_doc.setdefault(d, []).append((a, b, kind))
    for d, spans in by_doc.items():
        pieces, last = [], 0
        for a, b, kind in sorted(spans):
            if b <= last:
                continue
            pieces += [texts[d][last : max(a, last)], f"[{kind.upper()}]" if a >= last else ""]
            last = b
        texts[d] = "".join(pieces) + texts[d][last:]
    at = batch.schema.get_field_index("text")
    return batch.set_column(at, "text", pa.array(texts, pa.string()))


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with every span replaced by its kind; null texts stay null."""
    tuned(docs.sparkSession)
    return by_slices(docs, lambda part: redact_slice(part, model), docs.schema)
