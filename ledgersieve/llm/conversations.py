"""Structure repair of conversations: cheapest edits by a min-plus product over a shared grammar.

Every turn becomes a symbol of its role and fault. Re-Pair rules, counted over the symbol strings of all
conversations, shorten the strings: the most frequent pairs become symbols of their own. A symbol has a
transfer matrix over four states (nothing yet, after a system, a user, an assistant turn): the cheapest
cost from state to state and the edits that take it. Matrices of rules are products of those of their two
symbols, computed once; strings are evaluated from the rules and equal strings once per task. A path through
a string is a rope, a chain of the rules' edits, joined at the end.

A string has at most ``BLOCK_ROWS`` turns, so a long conversation is several strings in several tasks. From
their costs alone follow the states between them, and with these the edits of each string. Only the text of
a conversation is read by one task, in order and row by row, since its digest allows nothing else.

Edits: keep (0), give a turn the role user or assistant (2), delete (3), insert an empty turn (2); a
truncated turn that is not deleted adds 1. Blank and repeated turns must go. Among edits of one cost
those whose initials come first in ASCII win; all edits of the same turns with the same cost differ
before one of them ends, so it does not matter in which order strings are joined and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .texts import slices, stored

BLOCK_ROWS = 4_096
_ROUNDS, _PAIRS_A_ROUND, _FIRST_RULE = 6, 16, 0xE000
_SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant. What an inserted or changed turn becomes, by state.
_STATES = range(4)
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_ROLES = {2: "user", 3: "assistant"}
# Inserted turns that end a conversation well, by state.
_ENDS = ("", "II", "I", "")
_INSERT, _CHANGE, _DELETE, _TRUNCATED = 2, 2, 3, 1

Cell = tuple[int, str]
Matrix = list[list[Cell | None]]


def damaged_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults made by a hash of conv_id and turn; nulls count as one space."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    plain = turns.select("conv_id", "turn", _or_space("role"), _or_space("text")).withColumn("kind", kind)
    return plain.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" ")).alias(column)


def repair_conversations(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost (longs) and audit, the initials of its edits.

    ``turns`` has conv_id, turn, role, text; further columns are ignored. Turns go by ``turn`` (nulls first);
    those of one number by role, then by a digest of the text, and equal ones are interchangeable. Null roles
    and texts count as one space, a null conv_id is a conversation. ``gaps`` are numbers missing between the
    smallest and the largest turn (0 if all are null). Of a turn's faults the first counts: blank,
    duplicate (role and text seen earlier), truncated (last character no end of a sentence). ``illegal`` counts
    neighbours whose roles' initials do not follow each other. No turns, no row.
    """
    bits = max(0, (block_rows - 1).bit_length())
    last = F.right(F.col("end"), F.lit(1))
    initial = F.left("role", F.lit(1))
    narrow = _keyed(turns).select(
        "conv_id", "turn", "role", "digest", F.rtrim(F.col("text"), F.lit(_SPACE)).alias("end"),
    ).select(
        "conv_id", "turn", "role", "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")).alias("initial"),
        (F.col("end") == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv_id", "turn", "role", "digest", "salt"]
    placed = stored(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt").withColumn("place", F.monotonically_increasing_id()),
        "placed_turns",
    )
    firsts = placed.filter("NOT blank").groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place"))
    marked = placed.drop("role", "digest").join(firsts.select("place", F.lit(True).alias("first")), "place", "left").selectExpr(
        "*", "NOT blank AND first IS NULL AS duplicate", "NOT blank AND first AND cut AS truncated"
    )
    symbol = F.expr("CASE WHEN blank OR duplicate THEN 'x' WHEN truncated THEN upper(initial) ELSE initial END")
    held = F.array_sort(F.collect_list(F.struct("place", symbol.alias("symbol"), "initial")))
    strings = lambda field: F.array_join(F.transform("held", lambda t: t[field]), "")
    count = lambda flag: F.count_if(flag).alias(flag)
    blocks = stored(
        marked.groupBy("conv_id", F.shiftright("place", bits).alias("block"))
        .agg(F.min("place").alias("block_id"), held.alias("held"), count("blank"), count("duplicate"), count("truncated"))
        .select(
            "conv_id", "block_id", strings("symbol").alias("symbols"), strings("initial").alias("initials"), "blank", "duplicate", "truncated"
        )
        .withColumn("illegal", F.length("initials") - 1 - F.regexp_count("initials", F.lit("s(?=u)|u(?=a)|a(?=u)"))),
        "symbol_strings",
    )
    rules = pair_rules(blocks.select("symbols").distinct())
    evaluated = stored(_evaluate(blocks.select("block_id", "symbols"), rules), "transfer_matrices")
    links = blocks.drop("symbols").join(evaluated.drop("audits"), "block_id")
    fields = ["block_id", "initials", "costs", "ranks"]
    ends = F.struct("block_id", F.left("initials", F.lit(1)).alias("head"), F.right("initials", F.lit(1)).alias("tail"), *fields[2:])
    totals = links.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(ends)).alias("blocks"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    )
    chained = stored(_chain(totals), "chained")
    pieces = (
        chained.select("number", F.explode(F.arrays_zip("block_ids", "cells")).alias("b"))
        .select("number", F.col("b.block_ids").alias("block_id"), F.col("b.cells").alias("cell"))
        .join(evaluated.select("block_id", "audits"), "block_id")
        .groupBy("number")
        .agg(F.array_sort(F.collect_list(F.struct("block_id", F.element_at("audits", F.col("cell") + 1).alias("piece")))).alias("p"))
        .select("number", F.array_join(F.col("p.piece"), "").alias("pieces"))
    )
    numbers = placed.filter("turn IS NOT NULL").groupBy(F.col("conv_id").alias("_conv")).agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps")
    )
    return (
        chained.join(pieces, "number")
        .join(numbers, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
        .select(
            "conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
            F.concat("pieces", "ending").alias("audit"),
        )
    )


def every_conversation(repairs: DataFrame, conversations: DataFrame) -> DataFrame:
    """``repairs`` with a row of zeros and an empty audit for each conv_id of ``conversations`` that has none."""
    ids = conversations.select(F.col("conv_id").alias("_conv")).distinct()
    others = [c for c in repairs.columns if c not in ("conv_id", "audit")]
    return ids.join(repairs, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in others],
        F.coalesce("audit", F.lit("")).alias("audit"),
    )


def _keyed(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", _or_space("role"), _or_space("text")).withColumn("digest", F.sha2("text", 256))


# --- grammar ----------------------------------------------------------------


def pair_rules(strings: DataFrame) -> list[tuple[str, str]]:
    """Re-Pair rules (symbol, pair it stands for) for a column of different strings, in the order they apply.

    Each round counts neighbouring symbols over all strings and replaces the most frequent pairs that have no
    symbol in common. Rounds and pairs bound the grammar, not the strings: what has no rule stays as it is.
    """
    rules: list[tuple[str, str]] = []
    text: Column = F.col(strings.columns[0])
    for _ in range(_ROUNDS):
        shortened = strings.select(text.alias("s")).filter(F.length("s") > 1)
        pairs = shortened.select(F.explode(F.expr("transform(sequence(1, length(s) - 1), i -> substring(s, i, 2))")).alias("pair"))
        counts = pairs.groupBy("pair").agg(F.count("*").alias("held")).filter("held > 1")
        used: set[str] = set()
        for row in counts.orderBy(F.desc("held"), "pair").limit(8 * _PAIRS_A_ROUND).collect():
            if used.isdisjoint(row.pair) and len(used) < 2 * _PAIRS_A_ROUND:
                used |= set(row.pair)
                rules.append((chr(_FIRST_RULE + len(rules)), row.pair))
                text = F.replace(text, F.lit(row.pair), F.lit(rules[-1][0]))
        if not used:
            break
    return rules


def symbol_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """The transfer matrix of every symbol, rules after the symbols they are made of."""
    matrices = {symbol: _turn_matrix(symbol) for symbol in "xsuaoSUAO"}
    for symbol, pair in rules:
        matrices[symbol] = _joined(matrices[pair[0]], matrices[pair[1]])
    return matrices


def _turn_matrix(symbol: str) -> Matrix:
    """One turn, with what may be inserted before it."""
    matrix: Matrix = [[None] * 4 for _ in _STATES]
    extra = _TRUNCATED if symbol.isupper() else 0
    for start in _STATES:
        state = start
        for inserted in range(3):
            options = [(state, _DELETE, "D")]
            if symbol != "x":
                options.append((_NEXT[state], _CHANGE + extra, "R"))
                if state in _KEPT[symbol.lower()]:
                    options.append((_KEPT[symbol.lower()][state], extra, "K"))
            for end, cost, letter in options:
                cell = (inserted * _INSERT + cost, "I" * inserted + letter)
                matrix[start][end] = min(cell, matrix[start][end] or cell)
            state = _NEXT[state]
    return matrix


def _joined(one: Matrix, two: Matrix) -> Matrix:
    def best(start: int, end: int) -> Cell | None:
        ways = [(a[0] + b[0], a[1] + b[1]) for a, b in ((one[start][mid], two[mid][end]) for mid in _STATES) if a and b]
        return min(ways, default=None)

    return [[best(start, end) for end in _STATES] for start in _STATES]


def evaluate_string(string: str, matrices: dict[str, Matrix]) -> tuple[list[int], list[int], list[str | None]]:
    """Costs, ranks and edits of a string from each state to each, state by state.

    A rank is the place of the edits among those from the same state, in ASCII order. Costs of ways that
    do not exist are -1.
    """
    costs, ranks, audits = [-1] * 16, [-1] * 16, [None] * 16
    for start in _STATES:
        # Per state: cost, rank of the path among those held, the path as a rope.
        paths: dict[int, tuple[int, int, tuple]] = {start: (0, 0, ())}
        for symbol in string:
            matrix, found = matrices[symbol], {}
            for middle, (cost, rank, rope) in paths.items():
                for end, cell in enumerate(matrix[middle]):
                    if cell is not None:
                        way = (cost + cell[0], rank, cell[1], rope)
                        if end not in found or way[:3] < found[end][:3]:
                            found[end] = way
            ranked = sorted(found, key=lambda end: found[end][1:3])
            paths = {end: (found[end][0], place, (found[end][3], found[end][2])) for place, end in enumerate(ranked)}
        for end, (cost, rank, rope) in paths.items():
            costs[4 * start + end], ranks[4 * start + end], audits[4 * start + end] = cost, rank, _flat(rope)
    return costs, ranks, audits


def _flat(rope: tuple) -> str:
    parts = []
    while rope:
        rope, part = rope
        parts.append(part)
    return "".join(reversed(parts))


def _evaluate(blocks: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """block_id with the matrix of its string: costs, ranks, audits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = symbol_matrices(rules)
        known: dict[str, tuple] = {}
        room = 2_000_000
        for batch in batches:
            for rows in slices(batch, "symbols", 200_000):
                out = []
                for string in rows.column("symbols").to_pylist():
                    result = known.get(string)
                    if result is None:
                        short = string
                        for symbol, pair in rules:
                            short = short.replace(pair, symbol)
                        result = evaluate_string(short, matrices)
                        if room >= len(string) + 32:
                            room -= len(string) + 32
                            known[string] = result
                    out.append(result)
                columns = list(zip(*out, strict=True))
                types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("block_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                    ["block_id", "costs", "ranks", "audits"],
                )

    return blocks.mapInArrow(run, "block_id long, costs array<long>, ranks array<long>, audits array<string>")


def _chain(totals: DataFrame) -> DataFrame:
    """Per conversation the cell of each block's matrix on its cheapest way, the cost and the ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Of equal strings, chains are equal too.
            ids, cells, costs, endings, illegal = [], [], [], [], []
            for blocks, within in zip(batch.column("blocks").to_pylist(), batch.column("illegal").to_pylist(), strict=True):
                chosen, cost, ending = cheapest_chain([(b["costs"], b["ranks"]) for b in blocks])
                between = sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(blocks, blocks[1:], strict=False))
                ids.append([b["block_id"] for b in blocks])
                cells.append(chosen)
                costs.append(cost)
                endings.append(ending)
                illegal.append(within + between)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i[0] for i in ids], pa.int64()), batch.column("conv_id"), batch.column("blank"), batch.column("duplicate"),
                    batch.column("truncated"), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(endings, pa.string()),
                    pa.array(ids, longs), pa.array(cells, pa.list_(pa.int32())),
                ],
                ["number", "conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "ending", "block_ids", "cells"],
            )

    kind = totals.schema["conv_id"].dataType.simpleString()
    return totals.mapInArrow(
        run,
        f"number long, conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, ending string, "
        "block_ids array<long>, cells array<int>",
    )


def cheapest_chain(blocks: list[tuple[list[int], list[int]]]) -> tuple[list[int], int, str]:
    """For blocks of costs and ranks in order: the cell taken in each, the cost in all and the turns inserted at the end.

    Costs to the end are summed up backwards; forwards, of the ways that keep to the cheapest the one of lowest rank is taken.
    """
    after = [[_INSERT * len(end) for end in _ENDS]]
    for costs, _ in reversed(blocks):
        later = after[-1]
        after.append([
            min(costs[4 * start + end] + later[end] for end in _STATES if costs[4 * start + end] >= 0) for start in _STATES
        ])
    after.reverse()
    state, cells = 0, []
    for (costs, ranks), here, later in zip(blocks, after, after[1:], strict=False):
        ends = [e for e in _STATES if costs[4 * state + e] >= 0 and costs[4 * state + e] + later[e] == here[state]]
        end = min(ends, key=lambda e: ranks[4 * state + e])
        cells.append(4 * state + end)
        state = end
    return cells, after[0][0], _ENDS[state]


# --- repaired turns ---------------------------------------------------------


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns after their edits: conv_id, place (from 0), edit (K, R or I), role, text.

    ``repairs`` has conv_id and audit as ``repair_conversations`` gives them for these turns.
    """
    kind = turns.schema["conv_id"].dataType
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "place", "edit", "role", "text"]
        types = [arrow_kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        rows: list[tuple] = []
        conv_id, place, volume = None, 0, 0
        for head, edit, role, text in _walk(batches):
            if head is not None:
                conv_id, place = head["conv_id"], 0
                continue
            rows.append((conv_id, place, edit, role, text))
            place, volume = place + 1, volume + len(text)
            if len(rows) >= 10_000 or volume > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows, volume = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return _in_order(turns, repairs).mapInArrow(run, f"conv_id {kind.simpleString()}, place long, edit string, role string, text string")


def repaired_digests(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """``repairs`` with repaired_sha256: the digest of the repaired turns as lines of role, colon and text."""
    fields = repairs.schema
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held, digest, lines = None, hashlib.sha256(), 0

        def batch() -> pa.RecordBatch:
            columns = [[row[f.name] for row, _ in done] for f in fields]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([d for _, d in done], pa.string())], [*fields.names, "repaired_sha256"])

        for head, edit, role, text in chain(_walk(batches), [({}, "", "", "")]):
            if head is not None:
                if held is not None:
                    done.append((held, digest.hexdigest()))
                held, digest, lines = head, hashlib.sha256(), 0
                if len(done) >= 1_000:
                    yield batch()
                    done = []
            else:
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if done:
            yield batch()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return _in_order(turns, repairs).mapInArrow(run, f"{schema}, repaired_sha256 string")


def _in_order(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """Each conversation's repair, then its turns in order, all in one task."""
    heads = repairs.select("conv_id", F.lit(0).alias("kind"), F.struct(*repairs.columns).alias("head"))
    rows = _keyed(turns).withColumn("kind", F.lit(1))
    both = heads.unionByName(rows, allowMissingColumns=True)
    order = ["conv_id", "kind", "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("kind", "head", "role", "text")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, "", "", "") where a conversation begins, else (None, edit, role, text) for a turn that stays or is inserted."""
    audit, at, state = "", 0, 0
    for batch in batches:
        for rows in slices(batch, "text"):
            kinds, heads, roles, texts = (rows.column(c).to_pylist() for c in ("kind", "head", "role", "text"))
            for kind, head, role, text in zip(kinds, heads, roles, texts, strict=True):
                if kind == 0:
                    for state in _inserted(audit, at, state):
                        yield None, "I", _ROLES[state], ""
                    audit, at, state = head["audit"], 0, 0
                    yield head, "", "", ""
                    continue
                while audit[at] == "I":
                    at, state = at + 1, _NEXT[state]
                    yield None, "I", _ROLES[state], ""
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = _KEPT[role[0]][state]
                    yield None, "K", role, text
                elif edit == "R":
                    state = _NEXT[state]
                    yield None, "R", _ROLES[state], text
    for state in _inserted(audit, at, state):
        yield None, "I", _ROLES[state], ""


def _inserted(audit: str, at: int, state: int) -> Iterator[int]:
    """States after the turns inserted at the end."""
    for _ in audit[at:]:
        state = _NEXT[state]
        yield state
