"""Repair of conversation structure by one integer per path.

A conversation is repaired by the cheapest edits whose kept and inserted rows have the role initials ``(s?(ua)+)?``. The
edits are a path through a directed acyclic graph of (rows read, letters written, state of the pattern), and every edge
weighs one integer: its high digits are the cost of the edit, its low digits, one to the base 5 for each place of the
audit, hold the edit's letter. Places that a shorter audit does not reach are zero, which sorts before every letter. So
the least integer is the cheapest audit and, among equally cheap ones, the least in ASCII; a shortest path decides all,
and its digits are the audit.

No cheapest audit inserts: an inserted row can go together with a neighbour (or, if that empties the pattern, with the
system row too) for at most 2 + 2 instead of its 5. The graph of a conversation of up to ``BLOCK`` rows has these edges
all the same. A longer one is read in blocks without them, where the integer carries the rank of what is left of the
earlier blocks instead of their letters, so that its width is bounded whatever the number of rows.

Two sorted streams do the work, and neither holds a conversation: one over small rows (no text) that finds faults and
audits, one over the texts that applies them. A row with a null conversation is of one conversation without an id, nulls in
role and text are one space, a null turn comes before all others; rows of one turn are ordered by role and then by the
MD5 of the text. Other columns are not read. A role without a letter of the pattern (also an empty one) can be kept nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from meterlake.llm.common import staged

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

LETTERS = "\0DIKR"  # digits 0 to 4: the end, then the edits in ASCII order
D, I, K, R = 1, 2, 3, 4
BLOCK = 64
BATCH = 2_000

#: States of the pattern: nothing, after s, after u, after a; what may come next, and where it leads.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
NEEDED = ["u", "u", "a", "u"]
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

BLANK, DUPLICATE, CUT = 1, 2, 3
NO_WORD = "^[\\x20\\x09-\\x0D]*\\z"
ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"


def steps(code: str, state: int) -> Iterator[tuple[int, int, int]]:
    """(letter, cost, next state) of each edit of a row in a state.

    ``code`` is the initial of the row's role (``o`` for any other than s, u, a), a capital if its text is truncated, or
    ``x`` if the row has to go.
    """
    yield D, DELETE, state
    if code != "x":
        extra, initial = (TRUNCATED, code.lower()) if code.isupper() else (0, code)
        if initial in NEXT[state]:
            yield K, extra, NEXT[state][initial]
        needed = NEEDED[state]
        yield R, REROLE + extra, NEXT[state][needed]


def block(codes: str, entry: list[int | None], inserts: int) -> list[int | None]:
    """The least integer by which each state is reached after ``codes``, from the integers of the states before them.

    An entry is 4 * cost + rank; an exit is that to the base ``5 ** (len(codes) + inserts)``, plus the letters' digits.
    """
    width = len(codes) + inserts
    top = 5**width
    place = [5 ** (width - 1 - p) for p in range(width)]
    unit = 4 * top
    reached: list[list[int | None]] = [[None if e is None else e * top for e in entry]] + [[None] * 4 for _ in range(inserts)]

    def insert(row: int) -> None:
        for k in range(inserts):
            for state, at in enumerate(reached[k]):
                if at is not None:
                    led, weight = NEXT[state][NEEDED[state]], at + INSERT * unit + I * place[row + k]
                    if reached[k + 1][led] is None or weight < reached[k + 1][led]:
                        reached[k + 1][led] = weight

    for row, code in enumerate(codes):
        insert(row)
        for k, states in enumerate(reached):
            after: list[int | None] = [None] * 4
            for state, at in enumerate(states):
                if at is not None:
                    for letter, cost, led in steps(code, state):
                        weight = at + cost * unit + letter * place[row + k]
                        if after[led] is None or weight < after[led]:
                            after[led] = weight
            reached[k] = after
    insert(len(codes))
    return [min((states[q] for states in reached if states[q] is not None), default=None) for q in range(4)]


def letters(digits: int, width: int) -> str:
    out = []
    for _ in range(width):
        digits, letter = divmod(digits, 5)
        out.append(LETTERS[letter])
    return "".join(reversed(out)).rstrip("\0")


def long_audit(codes: str) -> tuple[int, str]:
    """Cost and audit of any number of rows, block by block."""
    entry: list[int | None] = [0, None, None, None]
    trail: list[list[tuple[int, str] | None]] = []
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK]
        top = 5 ** len(part)
        ranked = {e % 4: state for state, e in enumerate(entry) if e is not None}
        exits = block(part, entry, 0)
        trail.append([None if e is None else (ranked[e // top % 4], letters(e % top, len(part))) for e in exits])
        order = sorted(e % (4 * top) for e in exits if e is not None)
        entry = [None if e is None else e // (4 * top) * 4 + order.index(e % (4 * top)) for e in exits]
    state = min((q for q in ENDS if entry[q] is not None), key=lambda q: entry[q])
    cost, parts = entry[state] // 4, []
    for exits in reversed(trail):
        state, part = exits[state]
        parts.append(part)
    return cost, "".join(reversed(parts))


@lru_cache(maxsize=100_000)
def short_audit(codes: str) -> tuple[int, str]:
    """Cost and audit of at most ``BLOCK`` rows; deleting them all costs 2 each, so a cheapest audit inserts no more than that buys."""
    inserts = DELETE * len(codes) // INSERT
    exits = block(codes, [0, None, None, None], inserts)
    top = 5 ** (len(codes) + inserts)
    best = min(exits[q] for q in ENDS if exits[q] is not None)
    return best // (4 * top), letters(best % top, len(codes) + inserts)


def audit_of(codes: str) -> tuple[int, str]:
    return short_audit(codes) if len(codes) <= BLOCK else long_audit(codes)


def replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of a conversation's rows."""
    state = 0
    for letter in audit:
        if letter == "I":
            role, text = ROLES[NEEDED[state]], ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "R":
                role = ROLES[NEEDED[state]]
        state = NEXT[state][role[0]]
        yield role, text


def damage(rows: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text, dropped`` after the damage that each row's conversation and turn call for."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("kind")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    whole = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).cast("int").alias("kind"),
    )
    hurt = whole.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (kind == 0).alias("dropped"), "kind")
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.withColumn("copy", F.explode(times)).drop("copy", "kind")


def _order() -> list:
    return ["conv_id", F.col("turn").asc_nulls_first(), "role", "text_key"]


def _clean(rows: DataFrame) -> DataFrame:
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), dropped.alias("dropped"), F.unhex(F.md5(text.cast("binary"))).alias("text_key"))


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _schema(like: DataFrame, longs: list[str], strings: list[str]) -> StructType:
    out = StructType([like.schema["conv_id"]])
    for name in longs:
        out = out.add(name, "long")
    for name in strings:
        out = out.add(name, "string")
    return out


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=schema.names)


def _batches(rows: Iterator[tuple], schema: StructType, size: Callable[[tuple], int] = lambda row: 0) -> Iterator[pa.RecordBatch]:
    done, held = [], 0
    for row in rows:
        done.append(row)
        held += size(row)
        if len(done) >= BATCH or held > 1 << 22:
            yield _batch(done, schema)
            done, held = [], 0
    if done:
        yield _batch(done, schema)


def _rows(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


def _summaries(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Summaries of the sorted rows ``conversation, turn, dropped, fault, initial``."""
    for conv, own in groupby(rows, key=lambda row: row[0]):
        codes, faults, illegal, before = bytearray(), [0] * 4, 0, ""
        first = last = None
        turns = 0
        for _, turn, dropped, fault, initial in own:
            if dropped:
                continue
            codes += b"x" if fault in (BLANK, DUPLICATE) else (initial.upper() if fault == CUT else initial).encode()
            faults[fault] += 1
            illegal += bool(before) and before + initial not in ("su", "ua", "au")
            before = initial
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
        cost, audit = audit_of(codes.decode())
        yield conv, 0 if first is None else last - first + 1 - turns, *faults[1:], illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Takes ``conv_id, turn, role, text`` and, if it is there, ``dropped``: such rows only make their conversation known. Text
    stays behind; what is sorted per conversation is a row of about 40 bytes.
    """
    initial = F.substring("role", 1, 1)
    small = _clean(rows).select(
        "conv_id", "turn", "role", "text_key", "dropped",
        F.when(F.col("text").rlike(NO_WORD), BLANK).when(~F.col("text").rlike(ENDED), CUT).otherwise(0).alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")).alias("initial"),
    )
    # the repartition has put conversations together for the window, which numbers rows as they pass and holds none
    again = F.row_number().over(W.partitionBy("conv_id", "dropped", "role", "text_key").orderBy(F.col("turn").asc_nulls_first())) > 1
    judged = small.repartition("conv_id").withColumn("fault", F.when((F.col("fault") != BLANK) & again, DUPLICATE).otherwise(F.col("fault")))
    stream = judged.sortWithinPartitions(*_order()).select("conv_id", "turn", "dropped", "fault", "initial")
    out = _schema(rows, SUMMARY, ["audit"])
    return stream.mapInArrow(lambda batches: _batches(_summaries(_rows(batches, 4096)), out), out)


def _with_texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows in order behind the summary of their conversation, which travels as the first row of it."""
    texts = _clean(rows).filter(~F.col("dropped")).drop("dropped").withColumn("head", F.lit(None).cast(found.select(F.struct(*SUMMARY, "audit").alias("head")).schema["head"].dataType))
    heads = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(b"").alias("text_key"), F.struct(*SUMMARY, "audit").alias("head"))
    both = texts.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("head").isNull(), *_order()[1:]).select("conv_id", "role", "text", "head")


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, summary, its repaired rows); each one's rows have to be read before the next is asked for."""
    for conv, own in groupby(rows, key=lambda row: row[0]):
        head = next(own)[3]
        yield conv, head, replay(head["audit"], ((role, text) for _, role, text, _ in own))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows, ``conv_id, at, role, text``, by the audits in ``found``."""
    out = _schema(rows, ["at"], ["role", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = ((conv, at, *row) for conv, _, own in _replayed(_rows(batches)) for at, row in enumerate(own))
        return _batches(each, out, lambda row: len(row[3]))

    return _with_texts(rows, found).mapInArrow(run, out)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``: the SHA-256 of each conversation's repaired ``role:text``, joined by newlines."""
    out = _schema(rows, SUMMARY, ["audit", "repaired_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for conv, head, own in _replayed(_rows(batches)):
                sha = hashlib.sha256()
                for at, (role, text) in enumerate(own):
                    sha.update(("\n" * (at > 0) + f"{role}:{text}").encode())
                yield conv, *(head[name] for name in SUMMARY), head["audit"], sha.hexdigest()

        return _batches(each(), out)

    return _with_texts(rows, found).mapInArrow(run, out)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Summaries of all conversations, written once, and their repaired rows."""
    found = staged(audits(rows), "audits")
    return found, repaired(rows, found)
