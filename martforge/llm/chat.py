"""Chat formatting with minimum-cost role repair.

A legal conversation is: at most one system turn, then user and assistant turns in alternation, from user to
assistant. A sequence of turns is made legal at least cost: keep a turn (0), merge it into the one before (1; 2 if its
role is unknown, 4 if it says another one), relabel it (3; 2 if unknown), or insert an empty turn (2). The cheapest
repair is a shortest path through the automaton of legal turns, and one turn is a 4 x 4 matrix of costs between
states, so that repair is a product of matrices under (min, +). That product is associative: conversations are cut
into blocks of at most 4096 turns wherever they lie, the blocks' matrices are joined to find the state between any
two blocks, and each block then finds its own decisions. So one conversation may hold a third of all turns. Texts stay
in Spark; Python sees roles only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import python_tasks
from martforge.llm.shingles import batches_of
from martforge.session import materialize

ROLES = ("system", "user", "assistant")
UNKNOWN = 3
#: Names that other formats give the roles.
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)  # a state is the last turn's role + 1
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INSERT, MERGE, MERGE_UNKNOWN, MERGE_OTHER, RELABEL, RELABEL_UNKNOWN = 2, 1, 2, 4, 3, 2
BLOCK_BITS = 12
FAR = 1 << 40


def _bridges() -> dict[tuple[int, int], list[int]]:
    """Fewest empty turns that lead from one state to another (a system turn is never inserted)."""
    paths = {(s, s): [] for s in range(4)}
    for _ in range(4):
        for (a, b), path in list(paths.items()):
            for c in NEXT[b]:
                if c != SYSTEM and len(path) + 1 < len(paths.get((a, c), [0] * 9)):
                    paths[a, c] = [*path, c]
    return paths


BRIDGES = _bridges()


def _steps(role: int) -> dict[tuple[int, int], tuple[int, str, list[int]]]:
    """(state, next state) -> (cost, action, inserted roles) of one turn; the first of equal costs by this order."""
    best: dict = {}

    def offer(a, b, cost, action, inserted):
        if cost < best.get((a, b), (FAR,))[0]:
            best[a, b] = (cost, action, inserted)

    for a in range(4):
        if a != START:
            own = MERGE if role + 1 == a else MERGE_UNKNOWN if role == UNKNOWN else MERGE_OTHER
            offer(a, a, own, "merge", [])
        for (s, t), inserted in BRIDGES.items():
            if s == a:
                for b in NEXT[t]:
                    keep = role + 1 == b
                    cost = 0 if keep else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL
                    offer(a, b, cost + INSERT * len(inserted), "keep" if keep else "relabel", inserted)
    return best


STEPS = [_steps(r) for r in range(4)]
MATRIX = np.full((4, 4, 4), FAR, np.int64)
for _r, _best in enumerate(STEPS):
    for (_a, _b), _step in _best.items():
        MATRIX[_r, _a, _b] = _step[0]
#: From a state to the end: a conversation ends after an assistant's turn.
ENDING = {s: BRIDGES[s, ASSISTANT] for s in (SYSTEM, USER, ASSISTANT)}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def block_matrix(roles: list[int]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        out = product(out, MATRIX[r])
    return out


def states_between(blocks: list[np.ndarray]) -> list[int]:
    """States before, between and after the blocks on a cheapest way from the start to a legal end."""
    costs = [np.where(np.arange(4) == START, 0, FAR)]
    for m in blocks:
        costs.append(np.minimum((costs[-1][:, None] + m).min(axis=0), FAR))
    end = np.array([INSERT * len(ENDING[s]) if s in ENDING else FAR for s in range(4)])
    states = [int((costs[-1] + end).argmin())]
    for m, cost in zip(reversed(blocks), reversed(costs[:-1])):
        states.append(int((cost + m[:, states[-1]]).argmin()))
    return states[::-1]


def decisions(roles: list[int], entry: int, leave: int) -> list[tuple[int, int, str, list[int]]]:
    """Per turn: state after it, cost, action and inserted roles on a cheapest way from entry to leave."""
    costs = [np.where(np.arange(4) == entry, 0, FAR)]
    for r in roles:
        costs.append(np.minimum((costs[-1][:, None] + MATRIX[r]).min(axis=0), FAR))
    out, state = [], leave
    for r, cost in zip(reversed(roles), reversed(costs[:-1])):
        before = int((cost + MATRIX[r][:, state]).argmin())
        out.append((state, *STEPS[r][before, state]))
        state = before
    return out[::-1]


def _matrices(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("matrix", pa.list_(pa.int64()))])

    def rows():
        for batch in batches:
            for x in batch.to_pylist():
                turns = sorted((t["place"], t["code"]) for t in x["turns"])
                yield {"conv_id": x["conv_id"], "block": x["block"], "matrix": block_matrix([c for _, c in turns]).ravel()}

    yield from batches_of(rows(), schema)


def _joining(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()),
                        ("last", pa.bool_())])

    def rows():
        for batch in batches:
            for x in batch.to_pylist():
                blocks = sorted(x["blocks"], key=lambda b: b["block"])
                states = states_between([np.array(b["matrix"]).reshape(4, 4) for b in blocks])
                for i, b in enumerate(blocks):
                    yield {"conv_id": x["conv_id"], "block": b["block"], "entry": states[i], "leave": states[i + 1],
                           "last": i + 1 == len(blocks)}

    yield from batches_of(rows(), schema)


def _deciding(batches):
    schema = pa.schema([("place", pa.int64()), ("action", pa.string()), ("new_role", pa.string()), ("cost", pa.int32()),
                        ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())), ("first", pa.bool_()),
                        ("ends", pa.bool_())])
    names = lambda states: [ROLES[s - 1] for s in states]

    def rows():
        for batch in batches:
            for x in batch.to_pylist():
                turns = sorted((t["place"], t["code"]) for t in x["turns"])
                found = decisions([c for _, c in turns], x["entry"], x["leave"])
                for i, ((place, _), (state, cost, action, inserted)) in enumerate(zip(turns, found)):
                    ends = x["last"] and i + 1 == len(turns)
                    after = ENDING[state] if ends else []
                    yield {"place": place, "action": action, "new_role": ROLES[state - 1],
                           "cost": cost + INSERT * len(after), "before": names(inserted), "after": names(after),
                           "first": i == 0 and x["entry"] == START, "ends": ends}

    yield from batches_of(rows(), schema)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", opens: str = "<|im_start|>", closes: str = "<|im_end|>") -> DataFrame:
    """One row per turn: ``conv_id, turn, place, role, action, new_role, inserted_before, inserted_after, cost, rendered``.

    ``action`` is keep, merge or relabel. ``rendered`` is the turn's part of its conversation, inserted empty turns
    included: the parts of a conversation in ascending ``place`` make the formatted conversation. The sum of ``cost``
    over a conversation is least; of equally cheap repairs the states with the smaller number (system, user,
    assistant) win from the end backwards.

    Turns are ordered by turn number, then by role and text (nulls first, bytes ascending), whatever the partitions; repeated rows are turns of their own. A null
    text is empty, a null or other role unknown, a null conversation id one conversation. The two markers lose their
    meaning inside texts (a space follows their first ``<|``). An empty table gives no rows. Other columns are not read.
    """
    python_tasks(turns.sparkSession)
    name = F.lower(F.trim(F.col(role_col)))
    code = F.lit(UNKNOWN)
    for alias, role in [*ALIASES.items(), *zip(ROLES, ROLES)]:
        code = F.when(name == alias, ROLES.index(role)).otherwise(code)
    rows = (turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.col(role_col).alias("role"), F.col(text_col).alias("text"), code.alias("code"))
            .repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 256))  # in the order of text, but short
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .withColumn("place", F.monotonically_increasing_id()))
    rows = materialize(rows, "chat-turns")
    blocks = (rows.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"))
              .agg(F.collect_list(F.struct("place", "code")).alias("turns")))
    blocks = materialize(blocks, "chat-blocks")
    joined = (blocks.mapInArrow(_matrices, "conv_id long, block long, matrix array<long>").groupBy("conv_id")
              .agg(F.collect_list(F.struct("block", "matrix")).alias("blocks"))
              .mapInArrow(_joining, "conv_id long, block long, entry int, leave int, last boolean"))
    same = F.col("b.conv_id").eqNullSafe(F.col("j.conv_id")) & (F.col("b.block") == F.col("j.block"))
    found = (blocks.alias("b").join(joined.alias("j"), same).select("b.turns", "j.entry", "j.leave", "j.last")
             .mapInArrow(_deciding, "place long, action string, new_role string, cost int, before array<string>, "
                                    "after array<string>, first boolean, ends boolean"))
    plain = F.coalesce("text", F.lit(""))
    for marker in (opens, closes):
        plain = F.replace(plain, F.lit(marker), F.lit(marker[:2] + " " + marker[2:]))
    empty = lambda roles: F.concat_ws("", F.transform(roles, lambda r: F.concat(F.lit(opens), r, F.lit("\n" + closes + "\n"))))
    close = F.lit(closes + "\n")
    begin = F.concat(F.when(F.col("first"), F.lit("")).otherwise(close), empty(F.col("before")), F.lit(opens),
                     F.col("new_role"), F.lit("\n"), plain)
    part = F.when(F.col("action") == "merge", F.concat(F.lit("\n"), plain)).otherwise(begin)
    rendered = F.concat(part, F.when(F.col("ends"), F.concat(close, empty(F.col("after")))).otherwise(F.lit("")))
    return rows.join(found, "place").select(
        "conv_id", "turn", "place", "role", "action", "new_role", F.col("before").alias("inserted_before"),
        F.col("after").alias("inserted_after"), "cost", rendered.alias("rendered"))
