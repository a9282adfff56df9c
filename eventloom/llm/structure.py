"""Repair of the turn structure of conversations by a cheapest sequence of edits.

A conversation is legal if the first letters of its roles read ``(s?(ua)+)?``: perhaps a system turn,
then user and assistant in turn. Rows are kept, given another role, deleted, or turns with an empty
text are inserted; the cheapest edits that make the conversation legal win, and among
equally cheap ones those whose letters (Delete, Insert, Keep, Rerole) come first as text.

The choice is a shortest path in an acyclic graph whose nodes are (rows consumed, state of the
pattern, turns just inserted). The length of a path is one integer: its high digits are the cost, below
them stand the letters of the edits, three bits each, first letter highest, in a field of fixed
width whose end is filled with zeros. Plain integer minima thus settle cost and ties at once. So that the
integers stay short in long conversations, the field covers ``CHUNK_ROWS`` rows; at the end of
such a chunk the letters of the four states move to a list and their order among each other stays as one
leading digit. That is exact: in a given state a letter leads to one state only, so at a row's end no
path is a beginning of another, and the first letter that differs has settled their order for good.

The rows of a conversation are sorted by Spark and streamed through the task that holds it, which
keeps four paths and one hash state for each, whatever the number of rows; only the letters of the
paths grow. Which rows repeat an earlier one is found before, by a window over equal rows, so neither
the texts nor their hashes are gathered anywhere. A digest over the repaired
texts in order ties a conversation to one task at the last step.

Rows: a null role or text is one space. Rows without an id form a conversation of their own. Rows of a
conversation go by turn, null turns first, then by role and text; equal rows follow each other, the
first of them counts as not repeated. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of the edits, and of a truncated row that stays.
KEEP, INSERT, REROLE, DELETE, CUT_OFF = 0, 3, 3, 4, 3
#: Digits of the letters, in the order of the letters as text.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = " DIKR"
#: States of the pattern: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The turn that may follow a state where it can be chosen freely.
CHOSEN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: More inserted turns in a row than these would only come back to a state already passed.
MOST_INSERTS = 2

CHUNK_ROWS = 64
FIELD = CHUNK_ROWS * (1 + MOST_INSERTS) + MOST_INSERTS
#: Bits of letters, of letters with the leading digit.
LOW, COST_AT = 3 * FIELD, 3 * FIELD + 3

OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ORDER = ["turn", "role", "text", "repeated"]


def faulty_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, repeated, fault) of rows (conv_id, turn, role, text); null roles and texts are a space.

    ``repeated`` numbers equal roles and texts of a conversation by turn, from 1. A column ``gone``
    marks rows that stand for their conversation only.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        gone.alias("gone"),
    )
    equal = Window.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, BLANK).when(F.col("repeated") > 1, DUPLICATE).when(~ended, TRUNCATED).otherwise(SOUND)
    return plain.withColumn("repeated", F.row_number().over(equal)).withColumn("fault", fault)


class Repair:
    """Edits of one conversation, found while its rows come in."""

    def __init__(self):
        self.counts = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last_initial = None
        self.in_chunk = 0
        #: Per state that can be reached: weight, letters in the field, letters before it, hash of the turns so far.
        self.paths = {START: (0, 0, None, hashlib.sha256())}

    @staticmethod
    def after(path: tuple, cost: int, letter: str) -> tuple[int, int]:
        """Weight and number of letters of a path with one more edit."""
        weight, letters = path[:2]
        return weight + (cost << COST_AT) + (DIGITS[letter] << (LOW - 3 * (letters + 1))), letters + 1

    @staticmethod
    def hashed(path: tuple, state: int, role: str, text: str):
        digest = path[3].copy()
        digest.update(f"{'' if state == START else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        return digest

    def insert(self) -> None:
        """Turns inserted where the paths stand: one layer of the graph for each."""
        layer = self.paths
        for _ in range(MOST_INSERTS):
            made = {}
            for state, path in layer.items():
                to = NEXT[state, CHOSEN[state][0]]
                found = self.after(path, INSERT, "I")
                best = min((p[0] for p in (made.get(to), self.paths.get(to)) if p), default=None)
                if best is None or found[0] < best:
                    made[to] = (*found, path[2], self.hashed(path, state, CHOSEN[state], ""))
            self.paths = self.paths | made
            layer = made

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.counts[fault] += 1
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial = initial
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.insert()
        extra = CUT_OFF if fault == TRUNCATED else 0
        best: dict[int, tuple] = {}
        for state, path in self.paths.items():
            ways = [(state, DELETE, "D", None)]
            if fault in (SOUND, TRUNCATED):
                if (state, initial) in NEXT:
                    ways.append((NEXT[state, initial], KEEP + extra, "K", role))
                ways.append((NEXT[state, CHOSEN[state][0]], REROLE + extra, "R", CHOSEN[state]))
            for to, cost, letter, new_role in ways:
                found = self.after(path, cost, letter)
                if to not in best or found[0] < best[to][0][0]:
                    best[to] = found, path, state, new_role
        self.paths = {
            to: (*found, path[2], path[3] if new_role is None else self.hashed(path, state, new_role, text))
            for to, (found, path, state, new_role) in best.items()
        }
        self.in_chunk += 1
        if self.in_chunk == CHUNK_ROWS:
            self.shorten()

    @staticmethod
    def letters(path: tuple) -> str:
        return "".join(LETTERS[(path[0] >> (LOW - 3 * (i + 1))) & 7] for i in range(path[1]))

    def shorten(self) -> None:
        """Put the letters aside; their order among the states stays as one digit."""
        texts = (1 << COST_AT) - 1
        rank = {state: i for i, state in enumerate(sorted(self.paths, key=lambda s: self.paths[s][0] & texts), 1)}
        self.paths = {
            state: ((path[0] >> COST_AT << COST_AT) + (rank[state] << LOW), 0, (path[2], self.letters(path)), path[3])
            for state, path in self.paths.items()
        }
        self.in_chunk = 0

    def result(self) -> tuple:
        self.insert()
        path = min((self.paths[s] for s in (START, ASSISTANT) if s in self.paths), key=lambda p: p[0])
        pieces, before = [self.letters(path)], path[2]
        while before is not None:
            before, piece = before
            pieces.append(piece)
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        faults = (self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED])
        return gaps, *faults, self.illegal, path[0] >> COST_AT, "".join(reversed(pieces)), path[3].hexdigest()


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation its gaps, faults, illegal neighbours, and the cost, letters and digest of its repair."""
    faulty = faulty_rows(rows)
    order = ["conv_id", F.col("turn").asc_nulls_first(), *ORDER[1:]]
    sorted_rows = faulty.repartition("conv_id").sortWithinPartitions(*order)
    names = ["conv_id", *[c.split()[0] for c in OUT.split(", ")]]
    kinds = [pa.int64() if " long" in c else pa.string() for c in OUT.split(", ")]

    def stream(batches) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        open_, held, id_kind = False, None, None

        def made() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [id_kind, *kinds], strict=True)], names)

        for batch in batches:
            id_kind = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "gone")]
            for conv, turn, role, text, fault, gone in zip(*columns, strict=True):
                if not open_ or conv != held:
                    if open_:
                        done.append((held, *repair.result()))
                    open_, held, repair = True, conv, Repair()
                if not gone:
                    repair.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield made()
                done.clear()
        if open_:
            done.append((held, *repair.result()))
        if done:
            yield made()

    kept = sorted_rows.select("conv_id", "turn", "role", "text", "fault", "gone")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return kept.mapInArrow(stream, f"conv_id {id_type}, {OUT}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of all repaired conversations, positions from 1."""
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), *ORDER[1:])
    numbered = faulty_rows(rows).where(~F.col("gone")).withColumn("row", F.row_number().over(ordered).cast("long"))
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def edits(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for begin in range(0, len(audit), 10_000) if audit else []:
                    part = audit[begin : begin + 10_000]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([conv] * n, batch.column(0).type), pa.array(range(begin, begin + n), pa.int64()), pa.array(list(part))],
                        ["conv_id", "step", "edit"],
                    )

    steps = repairs(rows).select("conv_id", "audit").mapInArrow(edits, f"conv_id {id_type}, step long, edit string")
    upto = Window.partitionBy("conv_id").orderBy("step")
    steps = steps.select(
        "conv_id",
        "edit",
        F.count_if(F.col("edit") != "I").over(upto).alias("row"),
        F.count_if(F.col("edit") != "D").over(upto).alias("position"),
    ).where(F.col("edit") != "D")
    own = numbered.select(F.col("conv_id").alias("_conv"), F.col("row").alias("_row"), F.col("role").alias("_role"), F.col("text").alias("_text"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("row") == F.col("_row")) & (F.col("edit") != "I")
    joined = steps.join(own, same, "left")
    first = Window.partitionBy("conv_id").orderBy("position")
    # After a system turn that was kept, users stand at even positions, otherwise at odd ones.
    system_first = F.first(F.coalesce((F.col("edit") == "K") & F.startswith(F.col("_role"), F.lit("s")), F.lit(False))).over(first)
    chosen = F.when((F.col("position") + system_first.cast("int")) % 2 == 1, "user").otherwise("assistant")
    return joined.select(
        "conv_id",
        "position",
        "edit",
        F.when(F.col("edit") == "K", F.col("_role")).otherwise(chosen).alias("role"),
        F.coalesce("_text", F.lit("")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by the remainder of a checksum of ``conv_id:turn``, to try the repair on.

    0 of 20 drops a row (it stays with ``gone`` set, so that its conversation is known), 1 empties its text,
    2 takes the sentence ends from it, 3 repeats it, 4 makes it a user's.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
    fated = rows.select("conv_id", "turn", "role", "text", fate.alias("fate"))
    return fated.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"),
        (F.col("fate") == 0).alias("gone"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
