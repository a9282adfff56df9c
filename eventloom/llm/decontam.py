"""Benchmark passages in documents: CGK embedding, bit-sampling hashes and exact edit distance.

Texts are compared as lower-case words with one space between. A document holds an item of
length L if some stretch of it is at an edit distance of at most ``share * L`` from the item.

Lengths and distances count characters; windows and q-grams lie on bytes. Windows of the size
of an item start at every word, and wherever a q-gram of the text, by its place in the item,
says that the item would start, so that text without spaces is searched as well. A window within
the distance shares at least ``L - q + 1 - q * distance`` of the item's q-grams (in ASCII), each
moved by at most the distance, so windows with fewer of them drop out without loss. The others are embedded by random walks (Chakraborty, Goldenberg
and Koucky 2016): at each of 3 L steps a walk writes its symbol and stays or moves on, as a random function of
step and symbol says, which turns edit distance into Hamming distance. Several
walks, each sampled at several sets of bit positions, give hash keys; windows and items that
share a key are compared exactly, with the window's surroundings, by bit-parallel edit
distance. Repeats are chosen so that a window at the largest distance is found
with probability 0.95 or more, and near ones almost surely (``tests/llm`` measures it).

Long items are searched by parts of at most ``PART`` characters: the edits of a stretch cannot
exceed the share in every part, so at least one part has a window within its own distance. The
whole item is then compared around it. Windows and parts are embedded in batches of bounded
total size, so memory follows neither the longest item nor the number of windows.

Documents are only scanned: blocks of a bounded number of different items travel with the scan,
one scan per block; items of equal text are searched once. Null and empty documents hold nothing. Items of fewer than ``shortest`` characters
are looked up without windows: one that allows ``d`` edits is cut into ``d + 1`` pieces, of which
one must stand in the text unchanged, and is compared exactly around it; one that allows no edit
must stand there whole, not inside a longer word (in scripts that put spaces between words).
Equal items are all reported; repeated
document rows are reported once. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import free_name
from eventloom.llm.text import Words, by_slices, mixed, tuned

#: Items that travel with one scan, and total characters of them.
ITEMS, ITEM_BYTES = 20_000, 8_000_000
Q = 8
WALKS, SAMPLES, BITS = 10, 8, 11
#: Windows embedded at once, and bytes of them.
WINDOWS, WINDOW_BYTES = 4000, 1_000_000
#: Most characters of a part of an item.
PART = 2000
#: Most bytes between places at which stretches of text are judged by their q-grams.
GAP = 64
_RANDOM = np.random.default_rng(17)
_COIN = _RANDOM.integers(0, 256, 1 << 16, dtype=np.uint8)
_FILTER_BITS = 22
_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: Bytes of ASCII letters and digits, and first bytes of letters that take two bytes.
_LETTER = np.isin(np.arange(256), [*b"0123456789abcdefghijklmnopqrstuvwxyz"])
_TWO = (np.arange(256) >= 0xC3) & (np.arange(256) <= 0xDF)


def plain(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words, each followed by one space, as one buffer; the word starts in it, and
    the buffer offsets of the texts."""
    words = Words(column, lower=True)
    length = words.stop - words.start
    at = np.cumsum(length + 1) - length - 1
    data = np.full(int((length + 1).sum()), 0x20, np.uint8)
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    data[place + np.repeat(at, length)] = words.data[place + np.repeat(words.start, length)]
    bounds = np.append(at, len(data))
    return data, at, bounds[words.first]


def gram_codes(data: np.ndarray) -> np.ndarray:
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code, width = data.astype(np.uint64), 1
    while width < Q:  # stretches of twice the width, Q being a power of two
        code = (code[:-width] << np.uint64(8 * width)) | code[width:]
        width *= 2
    return (mixed(code) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def keys_of(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash keys (windows, WALKS * SAMPLES) of the strings ``data[start:start + size]``.

    A string shorter than the longest one is followed by blanks up to its own 3 L steps; keys
    sample steps by the string's own length, so equal lengths have equal samples.
    """
    n, steps = len(start), 3 * size
    walk = np.arange(WALKS)
    longest = int(steps.max())
    # Symbols and salts as 16-bit numbers, whose sums wrap as the coin table needs.
    symbols = np.append(data, np.zeros(longest + 1, np.uint8)).astype(np.uint16) * np.uint16(257)
    salts = mixed((walk * 1_000_003 + np.arange(longest)[:, None]).astype(np.uint64)).astype(np.uint16)
    at, end = np.repeat(start[:, None], WALKS, axis=1), (start + size)[:, None]
    keys = np.zeros((n, WALKS, SAMPLES), np.int64)
    # Sampled steps per walk, sample and bit as fractions of the length of the walk.
    share = np.random.default_rng(23).random((WALKS, SAMPLES, BITS))
    chosen = np.floor(share * steps[:, None, None, None]).astype(np.int64)
    written = np.zeros((n, WALKS, longest), bool)
    for step in range(longest):
        inside = at < end
        coin = _COIN[symbols[at] * inside + salts[step]]
        written[:, :, step] = coin & 2
        at += (coin & 1) & inside
    bits = written[np.arange(n)[:, None, None, None], walk[:, None, None], chosen]
    keys = (bits.astype(np.int64) << np.arange(BITS)).sum(axis=3)
    table = (walk[:, None] * SAMPLES + np.arange(SAMPLES)) << BITS
    return (keys + table).reshape(n, -1)


def keys_by_size(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``keys_of`` in batches of like size and bounded total size."""
    order = np.argsort(size, kind="stable")
    out, at = np.zeros((len(start), WALKS * SAMPLES), np.int64), 0
    while at < len(order):
        room = size[order[at : at + WINDOWS]]
        fits = int(np.searchsorted(room * np.arange(1, len(room) + 1), WINDOW_BYTES, "right"))
        part = order[at : at + max(1, fits)]
        out[part] = keys_of(data, start[part], size[part])
        at += len(part)
    return out


def search(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and where it first ends.

    Myers' bit-parallel scan with one long integer per column.
    """
    m = len(item)
    peq: dict[str, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | x) & full
        plus, minus = (down | ~(d0 | up)) & full, up & d0
        score += 1 if plus & top else -1 if minus & top else 0
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(d0 | plus)) & full, plus & d0
        if score < best:
            best, end = score, j + 1
    return best, end


@dataclass
class Index:
    """Items of one block, ready for the scan."""

    ids: list
    texts: list[str]
    allowed: np.ndarray  # edits, in characters
    whole: np.ndarray  # bytes
    slack: np.ndarray  # bytes by which the edits, and those of a part found, can move a place
    # Of each part of an item; short enough items are one part.
    owner: np.ndarray  # its item
    place: np.ndarray  # its first byte in the item
    sizes: np.ndarray  # bytes
    edits: np.ndarray  # bytes by which edits can move a place
    least: np.ndarray  # q-grams that are left after them
    posting: tuple[np.ndarray, np.ndarray, np.ndarray]  # sorted q-gram codes, part and place of each
    code: np.ndarray  # sorted (size, key) codes and the part of each
    part: np.ndarray


def code_of(size: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (size[:, None] << 20) + keys


@dataclass
class Pieces:
    """Short items of one block, as pieces of which one must be in the text unchanged."""

    ids: list
    texts: list[str]
    allowed: np.ndarray
    pairs: np.ndarray  # which two first bytes a piece can have
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # sorted hashes, item and place of each


def stretch_hashes(data: np.ndarray):
    """A function that hashes the stretches of one size that begin at the given places."""
    with np.errstate(over="ignore"):
        powers = lambda base: np.cumprod(np.append(np.uint64(1), np.full(len(data), base, np.uint64)), dtype=np.uint64)
        upto = np.append(np.uint64(0), np.cumsum(_VALUE[data] * powers(_BASE)[:-1], dtype=np.uint64))
        back = powers(pow(_BASE, -1, 1 << 64))
        return lambda start, size: (upto[start + size] - upto[start]) * back[start]


def item_table(items: pa.Table, share: float, shortest: int):
    """Buffer, starts, sizes, texts, allowed edits, bytes they move, q-grams they leave, and which items are short."""
    data, _, offsets = plain(items.column("text").combine_chunks())
    size, start = np.maximum(np.diff(offsets) - 1, 0), offsets[:-1]
    texts = [data[s : s + n].tobytes().decode("utf-8", "replace") for s, n in zip(start, size, strict=True)]
    chars = np.array([len(t) for t in texts], np.int64)
    widest = np.array([max(map(len, map(str.encode, set(t))), default=1) for t in texts], np.int64)
    allowed = np.floor(share * chars).astype(np.int64)
    least = size - Q + 1 - (Q + widest - 1) * allowed
    return data, start, size, texts, allowed, allowed * widest, least, (chars < shortest) | (least < 1)


def parts_of(value: str, share: float) -> list[tuple[int, int, int, int]]:
    """(place, size, edits, least) of the parts of an item in bytes; one part if a smaller one
    could lose all its q-grams."""

    def described(count: int):
        cuts = [len(value) * j // count for j in range(count + 1)]
        place = 0
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            piece = value[begin:end]
            size, widest, allowed = len(piece.encode()), max(len(c.encode()) for c in set(piece)), int(share * len(piece))
            yield place, size, allowed * widest, size - Q + 1 - (Q + widest - 1) * allowed
            place += size

    made = list(described(-(-len(value) // PART)))
    return made if all(least > 0 for *_, least in made) else list(described(1))


def build(items: pa.Table, share: float, shortest: int) -> Index | None:
    data, start, size, texts, allowed, edits, _, short = item_table(items, share, shortest)
    kept = np.flatnonzero(~short)
    if len(kept) == 0:
        return None
    parts = [(i, *part) for i, item in enumerate(kept) for part in parts_of(texts[item], share)]
    owner, place, sizes, moved, least = np.array(parts, np.int64).T
    start = start[kept][owner] + place
    cut = np.bincount(owner, minlength=len(kept)) > 1
    slack = edits[kept] + np.where(cut, np.maximum.reduceat(moved, np.searchsorted(owner, np.arange(len(kept)))), 0)
    each = [gram_codes(data[a : a + n]) for a, n in zip(start, sizes, strict=True)]
    flat, of = np.concatenate(each), np.repeat(np.arange(len(each)), list(map(len, each)))
    within = np.concatenate([np.arange(len(e)) for e in each])
    order = np.argsort(flat, kind="stable")
    posting = (flat[order], of[order], within[order])
    code = code_of(sizes, keys_by_size(data, start, sizes))
    of = np.repeat(np.arange(len(sizes)), code.shape[1])
    order = np.argsort(code.ravel(), kind="stable")
    ids = items.column("item_key").to_pylist()
    return Index(
        [ids[i] for i in kept], [texts[i] for i in kept], allowed[kept], size[kept], slack, owner, place, sizes, moved, least,
        posting, code.ravel()[order], of[order],
    )


def build_pieces(items: pa.Table, share: float, shortest: int) -> Pieces | None:
    _, _, size, texts, allowed, _, _, short = item_table(items, share, shortest)
    kept = np.flatnonzero(short & (size > 0))
    if len(kept) == 0:
        return None
    texts, allowed, ids = [texts[i] for i in kept], allowed[kept], items.column("item_key").to_pylist()
    pairs, found = np.zeros(1 << 16, bool), {}
    for i, value in enumerate(texts):
        n = min(int(allowed[i]) + 1, len(value))
        cuts = [len(value) * j // n for j in range(n + 1)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            piece = np.frombuffer(value[begin:end].encode(), np.uint8)
            first = int(piece[0]) << 8
            pairs[first | int(piece[1]) if len(piece) > 1 else slice(first, first + 256)] = True
            code = stretch_hashes(piece)(np.zeros(1, np.int64), len(piece))[0]
            found.setdefault(len(piece), []).append((code, i, len(value[:begin].encode())))
    by_size = {}
    for n, rows in found.items():
        code, item, place = (np.array(x, t) for x, t in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.int64), strict=True))
        order = np.argsort(code, kind="stable")
        by_size[n] = code[order], item[order], place[order]
    return Pieces([ids[i] for i in kept], texts, allowed, pairs, by_size)


def expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and the range of each."""
    count = high - low
    of = np.repeat(np.arange(len(low)), count)
    return np.arange(len(of)) + np.repeat(low - (np.cumsum(count) - count), count), of


def candidates(index: Index, codes: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (start, size) that hold enough q-grams of one item; ``words`` are the starts of
    words and ``offsets`` those of texts, the end of the last one included."""
    grams = np.zeros(1 << _FILTER_BITS, bool)
    grams[index.posting[0]] = True
    hit = grams[codes]
    before = np.concatenate([[0], np.cumsum(hit)])
    least, top = index.least, len(codes)
    # Places with a word start, or another place, at most GAP before any byte.
    length = np.diff(np.append(words, offsets[-1]))
    step, of = expanded(np.zeros(len(words), np.int64), -(-length // GAP))
    starts = words[of] + GAP * step
    doc = np.searchsorted(offsets, starts, "right")
    begins, ends = offsets[doc - 1], offsets[doc]
    reach = int((index.sizes + index.edits).max()) + GAP
    until = lambda x: np.minimum(x, top)
    near = np.flatnonzero(before[until(starts + reach)] - before[until(starts)] >= least.min())
    if len(near) == 0:
        return near, near
    # Stretches of such starts within one text, and the items whose q-grams they hold.
    new = np.concatenate([[True], (np.diff(starts[near]) > reach) | (np.diff(ends[near]) != 0)])
    first = near[new]
    last = near[np.append(np.flatnonzero(new)[1:], len(near)) - 1]
    held, stop = np.flatnonzero(hit), np.minimum(until(starts[last] + reach), ends[last])
    low = np.searchsorted(held, starts[first])
    entry, stretch = expanded(low, np.maximum(np.searchsorted(held, stop), low))
    place = held[entry]
    low, high = np.searchsorted(index.posting[0], codes[place]), np.searchsorted(index.posting[0], codes[place], "right")
    entry, of = expanded(low, high)
    # A q-gram of the text at its place in the item tells where the window would start.
    item, shift, where = index.posting[1][entry], place[of] - index.posting[2][entry], stretch[of]
    order = np.lexsort((shift, item, where))
    item, shift, where = item[order], shift[order], where[order]
    # A start is right if enough shifts lie within the edits of it, that is, if it lies in the
    # range around a run of so many shifts; overlapping ranges of one item and stretch are one.
    group = np.cumsum(np.concatenate([[0], (np.diff(item) != 0) | (np.diff(where) != 0)])) if len(item) else item
    run = np.flatnonzero(np.arange(len(item)) + least[item] <= len(item))
    till = run + least[item[run]] - 1
    close = (group[till] == group[run]) & (shift[till] - shift[run] <= 2 * index.edits[item[run]])
    run, till = run[close], till[close]
    low, high = shift[till] - index.edits[item[run]], shift[run] + index.edits[item[run]]
    new = np.concatenate([[True], (np.diff(group[run]) != 0) | (low[1:] > high[:-1])]) if len(run) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(run)) - 1 if len(run) else begin
    made = [np.zeros((2, 0), np.int64)]
    for i, j in zip(begin, end, strict=True):
        part, at = item[run[i]], where[run[i]]
        size, edits, a, b = int(index.sizes[part]), int(index.edits[part]), first[at], last[at]
        mine = words[np.searchsorted(words, max(low[i], starts[a])) : np.searchsorted(words, min(high[j], starts[b]), "right")]
        around = np.searchsorted(group, group[run[i]]), np.searchsorted(group, group[run[i]], "right")
        told = np.maximum(shift[around[0] : around[1]], begins[a])
        s = np.concatenate([mine, told[(told >= low[i]) & (told <= high[j])]])
        s = s[s + size - edits <= ends[a]]
        made.append(np.stack([s, np.full(len(s), size)]))
    found = np.unique(np.concatenate(made, axis=1), axis=1)
    return found[0], found[1]


def by_windows(data: np.ndarray, words: np.ndarray, offsets: np.ndarray, index: Index) -> dict[tuple[int, int], int]:
    """Least distance of (text, item) for the long items."""
    best: dict[tuple[int, int], int] = {}
    codes = gram_codes(data)
    if len(codes) == 0:
        return best
    start, size = candidates(index, codes, words, offsets)
    compared: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i in range(0, len(start), WINDOWS):
        s, n = start[i : i + WINDOWS], size[i : i + WINDOWS]
        code = code_of(n, keys_by_size(data, s, n)).ravel()
        window = np.repeat(np.arange(len(s)), WALKS * SAMPLES)
        low, high = np.searchsorted(index.code, code), np.searchsorted(index.code, code, "right")
        met = np.flatnonzero(high > low)
        pairs = {(int(window[j]), int(index.part[x])) for j in met for x in range(low[j], high[j])}
        doc = np.searchsorted(offsets, s, "right") - 1
        for w, part in sorted(pairs):
            d, item = int(doc[w]), int(index.owner[part])
            k, most = int(index.slack[item]), int(index.allowed[item])
            if best.get((d, item)) == 0:
                continue
            begin = int(s[w] - index.place[part])
            a, b = max(int(offsets[d]), begin - k), min(int(offsets[d + 1]), begin + int(index.whole[item]) + k)
            # Other windows and parts of the same passage need no comparison of their own.
            done = compared.setdefault((d, item), [])
            if any(x <= a and b <= y for x, y in done[-64:]):
                continue
            a, b = max(int(offsets[d]), a - k), min(int(offsets[d + 1]), b + k)
            done.append((a, b))
            found, _ = search(index.texts[item], data[a:b].tobytes().decode("utf-8", "ignore"))
            if found <= most and found < best.get((d, item), most + 1):
                best[(d, item)] = found
    return best


def by_pieces(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> dict[tuple[int, int], int]:
    """Least distance of (text, item) for the short items."""
    best: dict[tuple[int, int], int] = {}
    if len(data) < 2:
        return best
    two = _TWO[data]
    letter = _LETTER[data] | two
    letter[1:] |= two[:-1]
    inside = np.append(letter[1:] & letter[:-1], False)  # no boundary after this byte
    at = np.flatnonzero(pieces.pairs[(data[:-1].astype(np.int64) << 8) | data[1:]])
    hashed, sizes = stretch_hashes(data), np.array([len(t.encode()) for t in pieces.texts])
    tried: dict[tuple[int, str], int] = {}
    for size, (codes, items, places) in pieces.by_size.items():
        start = at[at + size <= len(data)]
        code = hashed(start, size)
        low, high = np.searchsorted(codes, code), np.searchsorted(codes, code, "right")
        entry, of = expanded(low, high)
        start, item, place = start[of], items[entry], places[entry]
        doc = np.searchsorted(offsets, start, "right") - 1
        exact = pieces.allowed[item] == 0
        whole = exact & ~((start > offsets[doc]) & inside[start - 1]) & ~inside[start + size - 1]
        for d, i in np.unique(np.stack([doc[whole], item[whole]]), axis=1).T.tolist():
            best[(d, i)] = 0
        for d, i, s in zip(doc[~exact].tolist(), item[~exact].tolist(), (start - place)[~exact].tolist(), strict=True):
            most = int(pieces.allowed[i])
            if best.get((d, i)) == 0:
                continue
            a, b = max(int(offsets[d]), s - 4 * most), min(int(offsets[d + 1]), s + int(sizes[i]) + 4 * most)
            around = data[a:b].tobytes().decode("utf-8", "ignore")
            if (i, around) not in tried:
                tried[(i, around)] = search(pieces.texts[i], around)[0]
            if tried[(i, around)] <= most:
                best[(d, i)] = min(best.get((d, i), most), tried[(i, around)])
    return best


def leaks_slice(batch: pa.RecordBatch, index: Index | None, pieces: Pieces | None) -> pa.RecordBatch | None:
    data, words, offsets = plain(batch.column("text"))
    ids, found = batch.column("doc_id").to_pylist(), []
    for part, best in ((index, index and by_windows(data, words, offsets, index)), (pieces, pieces and by_pieces(data, offsets, pieces))):
        found += [(ids[d], part.ids[i], distance) for (d, i), distance in (best or {}).items()]
    if not found:
        return None
    kinds = [pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], ["doc_id", "item_key", "distance"])


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.08, shortest: int = 24) -> DataFrame:
    """(doc_id, item_id, distance) of every item that a document holds, with its least distance."""
    tuned(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.sha2("text", 256).alias("item_key"), "text")
    texts = items.select("item_key", "text").dropDuplicates(["item_key"])
    count, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // ITEMS), -(-size // ITEM_BYTES))
    shape, found = "doc_id long, item_key string, distance long", None
    for block in range(blocks):
        part = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("item_key"), F.lit(blocks)) == block)
        part = part.orderBy("item_key").toArrow()
        index, pieces = build(part, share, shortest), build_pieces(part, share, shortest)
        if index is None and pieces is None:
            continue
        made = by_slices(rows, lambda batch, index=index, pieces=pieces: leaks_slice(batch, index, pieces), shape)
        found = made if found is None else found.unionByName(made)
    if found is None:
        return rows.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).cast("long").alias("distance"))
    found = found.groupBy("doc_id", "item_key").agg(F.min("distance").alias("distance"))
    return found.join(items.select("item_id", "item_key").distinct(), "item_key").groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def clean(docs: DataFrame, benchmark: DataFrame, share: float = 0.08, shortest: int = 24) -> DataFrame:
    """The documents that hold no item, all columns; those with a null id are judged together."""
    name = free_name(docs, "leaking_id")
    held = leaks(docs, benchmark, share, shortest).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(held, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
