"""Repair of conversations: the cheapest edits that leave alternating turns, shared by all conversations.

Every row of a conversation is one symbol: the initial of its role and whether its text is truncated, or one symbol
for all rows that must go (blank or duplicate). The symbols of a conversation are its signature. The repaired roles
must read ``(s?(ua)+)?``, which a grammar of four states accepts, and the cheapest edits depend on the rest of the
signature and the grammar state alone. So signatures are merged from their ends: an automaton has one node for each
distinct rest, and each node holds, per grammar state, its cost-to-go and the first edit of its best audit; the rest of
that audit is the successor's. Among equal costs the least letter wins (Delete, Insert, Keep, Rerole). Each letter
leads to one successor, so the audit that this spells is the ASCII-least.

Spark deals signatures out by ranges of their reversed text, and by conversation where they are equal: equal rests
stand next to each other, so a task builds every node once and drops it when the order leaves it. It holds no more
nodes than its longest signature has symbols, and a signature that a third of all conversations have is spread over
tasks. Rows travel without their texts, as digests, until the edits are known; long conversations are cut into
pieces by ranges of the row order, and the pieces' facts and symbols are joined. Texts are shuffled once, by
conversation, and streamed in order behind their audit. One digest over all texts of a conversation cannot be
computed in parts, so there a conversation is one task's stream; nothing of it is held but the audit.

Defined results: a null role or text is one space; rows follow turn (nulls first), copies at their row, rows that share
a turn follow role, the first ``HEAD`` letters of the text and its digest; a null conversation id is a conversation; an
empty role has no initial and cannot be kept, only reroled or deleted; repeated rows are duplicates; other columns are
ignored; an empty table gives no rows; texts may have any length. Texts are compared by MD5 digests.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import in_arrow, settled

#: Letters of a text that decide the order of rows that share turn and role.
HEAD = 32
#: Costs of the edits, and of leaving a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK, SPOKEN = r"[^\x20\x09-\x0D]", r"(?s)[.!?][\x20\x09-\x0D]*\z"
#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that the grammar takes in each state (besides a system row at the start), and the state it leads to.
NEXT = ("u", "u", "a", "u")
TO = (USER, USER, ASSISTANT, USER)
ROLE = {"u": "user", "a": "assistant"}
FAR = 1 << 60
GONE = "d"
ORDER = ("turn", "role", "head", "mark", "copy")
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def given(conversations: DataFrame) -> DataFrame:
    """The rows as they are: the columns that the operator works on, nothing dropped or copied."""
    return conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("dropped"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows, some of them dropped, emptied, stripped of sentence ends, repeated or given to the user."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *name).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = given(conversations).drop("copy", "dropped").withColumns({"_role": role, "_text": text, "dropped": fault == 0})
    return rows.select("conv_id", "turn", F.col("_role").alias("role"), F.col("_text").alias("text"), copies.alias("copy"), "dropped")


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.left("text", F.lit(HEAD)), "mark": F.unhex(F.md5("text"))})


def _symbols(rows: DataFrame) -> DataFrame:
    """Rows without texts: order columns, ``symbol`` (upper case: truncated), ``fault``, ``later`` (seen before)."""
    blank = ~F.col("text").rlike(BLANK)
    fault = F.when(blank, "blank").when(~F.col("text").rlike(SPOKEN), "truncated").otherwise("")
    marks = _placed(rows).select("conv_id", *ORDER, "dropped", fault.alias("fault"))
    place = F.struct("turn", "copy")
    first = (
        marks.filter(~F.col("dropped")).groupBy("conv_id", "role", "mark")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("mark") == F.col("_mark"))
    later = F.coalesce(place > F.col("first"), F.lit(False)) & ~F.col("dropped")
    return marks.join(first, same, "left").select("conv_id", *ORDER, "dropped", "fault", later.alias("later"))


class _Piece:
    """What is known of a stretch of one conversation's rows."""

    FIELDS = "conv_id {id}, rows long, turns long, low long, high long, first string, last string, " + ", ".join(f"{f} long" for f in FACTS[1:]) + ", signature string"

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.rows, self.turns, self.low, self.high = conv_id, 0, 0, None, None
        self.first = self.last = ""
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = 0
        self.symbols: list[str] = []
        self._before: tuple | None = None

    def add(self, turn: int | None, role: str, mark: bytes, fault: str, later: bool) -> None:
        same = (turn, role, mark) == self._before
        self._before = (turn, role, mark)
        if fault != "blank" and (later or same):
            fault = "duplicate"
        if fault:
            self.faults[fault] += 1
        initial = role[:1] or " "
        symbol = initial if initial in "sua" else "o"
        self.symbols.append(GONE if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol)
        self.rows += 1
        self._turn(turn, turn, 1)
        self._edge(initial, initial, 0)

    def join(self, rows: int, turns: int, low: int, high: int, first: str, last: str, blank: int, duplicate: int, truncated: int, illegal: int, signature: str) -> None:
        if not rows:
            return
        self.rows += rows
        for name, n in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
            self.faults[name] += n
        self._turn(low, high, turns)
        self._edge(first, last, illegal)
        self.symbols.append(signature)

    def _turn(self, low: int | None, high: int | None, turns: int) -> None:
        if low is None:
            return
        self.turns += turns - (self.high == low)
        self.low = low if self.low is None else self.low
        self.high = high

    def _edge(self, first: str, last: str, illegal: int) -> None:
        self.illegal += illegal + (bool(self.last) and self.last + first not in ("su", "ua", "au"))
        self.first = self.first or first
        self.last = last

    def row(self) -> tuple:
        return (self.conv_id, self.rows, self.turns, self.low, self.high, self.first, self.last, *self.faults.values(), self.illegal, "".join(self.symbols))


def _schema(names: str, id_type: str) -> str:
    return names.replace("{id}", id_type)


def _batch(rows: list[tuple], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(like)], schema=like)


def _grouped(batches: Iterator[pa.RecordBatch], start, add, like: pa.Schema, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of rows with one ``conv_id``; the stretch in hand is kept between batches."""
    state, out, size = None, [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv_id, *values in zip(*columns):
            if state is None or state.conv_id != conv_id:
                if state is not None:
                    out.append(state.row())
                    size += len(out[-1][-1]) + 100
                state = start(conv_id)
            add(state, values)
            if size > most:
                yield _batch(out, like)
                out, size = [], 0
    if state is not None:
        out.append(state.row())
    if out:
        yield _batch(out, like)


def _like(id_type: str, fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([("conv_id", kinds[id_type]), *fields])


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id``, the facts, and the symbols of each conversation in row order; one row per conversation."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    numbers = [(n, pa.int64()) for n in ("rows", "turns", "low", "high")]
    like = _like(id_type, [*numbers, ("first", pa.string()), ("last", pa.string()), *((f, pa.int64()) for f in FACTS[1:]), ("signature", pa.string())])
    schema = _schema(_Piece.FIELDS, id_type)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(piece: _Piece, values: list) -> None:
            turn, role, mark, dropped, fault, later = values
            if not dropped:
                piece.add(turn, role, mark, fault, later)

        yield from _grouped(batches, _Piece, add, like)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(batches, _Piece, lambda piece, values: piece.join(*values), like)

    symbols = settled(_symbols(rows), "repair-symbols")
    order = ["conv_id", *ORDER]
    cuts = symbols.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "mark", "dropped", "fault", "later")
    # the partitions are ranges of the row order, so their numbers order the pieces
    pieces = settled(in_arrow(cuts, cut, schema).withColumn("part", F.spark_partition_id()), "repair-pieces")
    merged = in_arrow(pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part").drop("part"), merge, schema)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return merged.select("conv_id", gaps, *FACTS[1:], "signature")


class Rests:
    """The automaton's nodes along one path from the end: node ``d`` is the rest of ``d`` symbols.

    A node holds, per grammar state, its cost-to-go and the letter of the first edit of its best audit.
    """

    def __init__(self) -> None:
        self.symbols = ""
        self.cost = [array("q") for _ in range(4)]
        self.edit = [bytearray() for _ in range(4)]
        self._node([0, FAR, FAR, 0], "    ")

    def _node(self, cost: list[int], edit: str) -> None:
        """Add a node from the costs of edits that use up a symbol, after adding what insertions allow."""
        letters = list(edit)
        for s, to in ((USER, ASSISTANT), (ASSISTANT, USER), (START, USER), (SYSTEM, USER)):
            if cost[to] + INSERT < cost[s] or (cost[to] + INSERT == cost[s] and letters[s] > "I"):
                cost[s], letters[s] = cost[to] + INSERT, "I"
        for s in range(4):
            self.cost[s].append(cost[s])
            self.edit[s].append(ord(letters[s]))

    def follow(self, rest: str) -> None:
        """Keep the nodes shared with ``rest`` (symbols from the end) and add the others."""
        shared = 0
        for a, b in zip(self.symbols, rest):
            if a != b:
                break
            shared += 1
        for s in range(4):
            del self.cost[s][shared + 1 :]
            del self.edit[s][shared + 1 :]
        for symbol in rest[shared:]:
            self._add(symbol)
        self.symbols = rest

    def _add(self, symbol: str) -> None:
        after = [c[-1] for c in self.cost]
        cost, edit = [], ""
        extra = TRUNCATED if symbol.isupper() else 0
        initial = symbol.lower()
        for s in range(4):
            ways = [(after[s] + DELETE, "D")]
            if symbol != GONE:
                if initial == NEXT[s]:
                    ways.append((after[TO[s]] + extra, "K"))
                elif s == START and initial == "s":
                    ways.append((after[SYSTEM] + extra, "K"))
                ways.append((after[TO[s]] + REROLE + extra, "R"))
            least = min(ways)
            cost.append(least[0])
            edit += least[1]
        self._node(cost, edit)

    def audit(self) -> tuple[int, str]:
        """Cost and edits of the whole signature: down the path, from the start of the grammar."""
        state, depth, edits = START, len(self.symbols), []
        while True:
            letter = chr(self.edit[state][depth])
            if letter == " ":
                return self.cost[START][len(self.symbols)], "".join(edits)
            edits.append(letter)
            symbol = self.symbols[depth - 1].lower() if letter != "I" else ""
            depth -= letter != "I"
            if letter != "D":
                state = SYSTEM if letter == "K" and symbol == "s" else TO[state]


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id``, the facts, ``cost`` and ``audit`` of each conversation."""
    found = settled(signatures(rows), "repair-signatures")
    id_type = found.schema["conv_id"].dataType.simpleString()
    like = _like(id_type, [*((f, pa.int64()) for f in (*FACTS, "cost")), ("audit", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rests, out, size = Rests(), [], 0
        cost, audit = rests.audit()
        for batch in batches:
            for conv_id, *facts, rest in zip(*(c.to_pylist() for c in batch.columns)):
                if rest != rests.symbols:
                    rests.follow(rest)
                    cost, audit = rests.audit()
                out.append((conv_id, *facts, cost, audit))
                size += 100 + len(audit)
                if size > 1 << 20:
                    yield _batch(out, like)
                    out, size = [], 0
        if out:
            yield _batch(out, like)

    turned = found.select("conv_id", *FACTS, F.reverse("signature").alias("rest"))
    dealt = turned.repartitionByRange("rest", "conv_id").sortWithinPartitions("rest", "conv_id")
    schema = f"conv_id {id_type}, " + ", ".join(f"{f} long" for f in (*FACTS, "cost")) + ", audit string"
    return in_arrow(dealt, task, schema)


class _Edits:
    """Applies an audit to the rows of a conversation as they come; yields ``(role, text, edit)``."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            self._at += 1
            yield ROLE[NEXT[self._state]], "", "I"
            self._state = TO[self._state]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        letter = self._audit[self._at]
        self._at += 1
        if letter == "R":
            role = ROLE[NEXT[self._state]]
        if letter != "D":
            self._state = SYSTEM if letter == "K" and role[:1] == "s" else TO[self._state]
            yield role, text, letter

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _behind_audits(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Audits and rows of each conversation together, the audit first, rows in order."""
    kept = _placed(rows.filter(~F.col("dropped"))).withColumns({"kind": F.lit(1)})
    heads = known.withColumn("kind", F.lit(0))
    order = ["conv_id", "kind", *ORDER]
    both = heads.unionByName(kept.drop("dropped"), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "audit", "role", "text", *FACTS, "cost")


def repaired(rows: DataFrame) -> DataFrame:
    """The rows after repair: ``conv_id, place, role, text, edit`` (K, R or I)."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    like = _like(id_type, [("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, conv, place = _Edits(""), None, 0
        for batch in batches:
            out = []
            for conv_id, kind, audit, role, text, *_ in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    for got in edits.end():
                        out.append((conv, place, *got))
                        place += 1
                    edits, conv, place = _Edits(audit), conv_id, 0
                    continue
                for got in edits.row(role, text):
                    out.append((conv, place, *got))
                    place += 1
            yield _batch(out, like)
        yield _batch([(conv, place + i, *got) for i, got in enumerate(edits.end())], like)

    together = _behind_audits(rows, settled(audits(rows), "repair-audits"))
    return in_arrow(together, task, f"conv_id {id_type}, place long, role string, text string, edit string")


class _Digest:
    """A conversation's facts, and the digest of its rows after repair."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self._facts, self._edits = conv_id, (), _Edits("")
        self._hash, self._lines = hashlib.sha256(), 0

    def add(self, values: list) -> None:
        kind, audit, role, text, *facts = values
        if kind == 0:
            self._facts, self._edits = (*facts, audit), _Edits(audit)
        else:
            self._write(self._edits.row(role, text))

    def _write(self, rows: Iterator[tuple[str, str, str]]) -> None:
        for role, text, _ in rows:
            self._hash.update(f"{chr(10) * (self._lines > 0)}{role}:{text}".encode())
            self._lines += 1

    def row(self) -> tuple:
        self._write(self._edits.end())
        return (self.conv_id, *self._facts, self._hash.hexdigest())


def digest(rows: DataFrame) -> DataFrame:
    """Facts, cost, audit and the digest of the repaired rows of each conversation."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    like = _like(id_type, [*((f, pa.int64()) for f in (*FACTS, "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    together = _behind_audits(rows, settled(audits(rows), "repair-audits"))
    schema = f"conv_id {id_type}, " + ", ".join(f"{f} long" for f in (*FACTS, "cost")) + ", audit string, repaired_sha256 string"
    return in_arrow(together, lambda batches: _grouped(batches, _Digest, _Digest.add, like), schema)
