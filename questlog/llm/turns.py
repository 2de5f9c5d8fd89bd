"""Conversation structure repair: the cheapest edits that make roles alternate.

Roles of a repaired conversation read `(s?(ua)+)?` by their initials. A conversation's rows are
aligned with the target of every length by Wagner-Fischer: all targets without `s` are ends of one
alternating string, so one table of rows by what remains of the target holds the alignment with
each of them, and one with `s` is a kept system row before such an end. A greedy repair gives the
cost to beat, and with it the band outside of which nothing can be as cheap (Ukkonen). Of the
cheapest alignments of all lengths the edits are traced back and compared.

Texts stay where they are: rows are sorted and numbered once, and alignments are made of one
letter for each row. A conversation too long for a table is cut into segments; each gives the
least cost from any state of the grammar to any other, and these meet in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.llm.common import cut

RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a piece, and rows up to which a conversation is aligned by one table.
PIECE, LONG = 4096, 2048
#: Space in the sense of the rules: U+0020 and U+0009 to U+000D.
_SPACE = " \t\n\x0b\x0c\r"
#: Letters of a row: by its role's initial (s, u, a or another), and by being sound, truncated or to be deleted.
SOUND, CUT_OFF, DOOMED = "suao", "SUAO", "0123"
#: A row's edits in full: rows put in before it (i user, I assistant), then kept, deleted, or renamed (r user, R assistant).
_TOKEN = r"[iI]*[KDrR](?:[iI]+\z)?"
_FAR = 1 << 40
#: States of the grammar: nothing yet, s, u, a; what may follow, and what ending there still costs.
_GO = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = ("u", "u", "a", "u")
_END = (0, 2 * INSERT, INSERT, 0)
_LEGAL = {"su", "ua", "au"}


def _class(code: str) -> str:
    return SOUND[(SOUND + CUT_OFF + DOOMED).index(code) % 4]


def illegal(codes: str) -> int:
    """Adjacent rows, faulty ones too, whose roles' initials may not follow each other."""
    own = "".join(map(_class, codes))
    return sum(own[i : i + 2] not in _LEGAL for i in range(len(own) - 1))


def _greedy(codes: str, rename: bool) -> int:
    """Cost of a right repair that takes each row as it comes."""
    cost, state = 0, 0
    for code in codes:
        to = _GO.get((state, _class(code)))
        if code in SOUND and (to or rename):
            cost += RENAME * (to is None)
            state = to or _GO[state, _NEXT[state]]
        else:
            cost += DELETE
    return cost + _END[state]


def align(codes: str) -> str:
    """The cheapest edits of a conversation, of those the least in ASCII: one letter each, in full.

    Row i of the table has the costs of rows i and after against the last r letters of uaua...ua,
    for r in a band: r below the rows left costs deletions, r above them insertions, and both no
    more than the incumbent's cost less what must be deleted anyway.
    """
    n = len(codes)
    doomed = np.array([c in DOOMED for c in codes], bool)
    left = np.concatenate([np.cumsum(~doomed[::-1])[::-1], [0]]) if n else np.zeros(1, int)
    spare = min(_greedy(codes, False), _greedy(codes, True), DELETE * n) - DELETE * int(doomed.sum())
    low, high = np.maximum(0, left - spare // DELETE), left + spare // INSERT
    table = [np.empty(0, np.int64)] * (n + 1)
    table[n] = INSERT * np.arange(low[n], high[n] + 1)
    head = [_FAR] * (n + 1)  # rows i and after against s and any such end but the empty one

    def at(i: int, r: int) -> int:
        return int(table[i][r - low[i]]) if low[i] <= r <= high[i] else _FAR

    def becomes(i: int, r: int) -> int:
        """Cost of row i's becoming the letter with r left of the target."""
        return (_class(codes[i]) != ("a" if r % 2 else "u")) * RENAME + (codes[i] in CUT_OFF) * TRUNCATED

    for i in range(n - 1, -1, -1):
        r = np.arange(low[i], high[i] + 1)
        below = np.full(high[i] - low[i] + 2, _FAR)  # row i + 1 for r - 1 and on
        first, last = max(low[i + 1], low[i] - 1), min(high[i + 1], high[i])
        if first <= last:
            below[first - low[i] + 1 : last - low[i] + 2] = table[i + 1][first - low[i + 1] : last - low[i + 1] + 1]
        best = below[1:] + DELETE
        if not doomed[i]:
            best = np.minimum(best, below[:-1] + np.where(r % 2, becomes(i, 1), becomes(i, 0)))
        table[i] = np.minimum.accumulate(best - INSERT * r) + INSERT * r
        head[i] = head[i + 1] + DELETE
        if _class(codes[i]) == "s" and not doomed[i]:
            even = table[i + 1][max(2, low[i + 1] + low[i + 1] % 2) - low[i + 1] :: 2]
            head[i] = min(head[i], int(even.min(initial=_FAR)) + (codes[i] in CUT_OFF) * TRUNCATED)
    lengths = range(low[0] + low[0] % 2, high[0] + 1, 2)
    least = min(head[0], min((at(0, r) for r in lengths), default=_FAR))

    def back(i: int, r: int) -> str:
        """Edits of rows i and after against the last r letters, the least in ASCII."""
        out = []
        while i < n or r:
            cost, letter = at(i, r), "a" if r % 2 else "u"
            if i < n and at(i + 1, r) + DELETE == cost:
                out.append("D")
                i += 1
            elif r and at(i, r - 1) + INSERT == cost:
                out.append("i" if letter == "u" else "I")
                r -= 1
            else:
                out.append("K" if _class(codes[i]) == letter else "r" if letter == "u" else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    found = [back(0, r) for r in lengths if at(0, r) == least]
    if head[0] == least:
        i = 0
        while head[i] == head[i + 1] + DELETE:
            i += 1
        rest = head[i] - (codes[i] in CUT_OFF) * TRUNCATED
        found += ["D" * i + "K" + back(i + 1, r) for r in range(max(2, low[i + 1] + low[i + 1] % 2), high[i + 1] + 1, 2) if at(i + 1, r) == rest]
    return min(found, key=str.upper)


def cost_of(codes: str, edits: str) -> int:
    """Cost of edits in full."""
    rows = (e for e in edits if e not in "iI")
    cost = INSERT * sum(e in "iI" for e in edits)
    for code, e in zip(codes, rows):
        cost += DELETE if e == "D" else RENAME * (e != "K") + TRUNCATED * (code in CUT_OFF)
    return cost


# --- conversations longer than a table

def _before(after: np.ndarray, code: str | None) -> np.ndarray:
    """Least cost from each state before a row, from what it is after it; no row: insertions only."""
    out = np.full_like(after, _FAR)
    if code is None:
        out[:] = after
    else:
        out[:] = after + DELETE
        if code not in DOOMED:
            own, more = _class(code), (code in CUT_OFF) * TRUNCATED
            for (state, letter), to in _GO.items():
                if letter != "s" or own == "s":
                    out[state] = np.minimum(out[state], after[to] + more + (own != letter) * RENAME)
    for _ in range(3):
        for state in range(4):
            out[state] = np.minimum(out[state], out[_GO[state, _NEXT[state]]] + INSERT)
    return np.minimum(out, _FAR)


def between(codes: str) -> np.ndarray:
    """Least cost over a segment from each state before it (rows) to each one after it (columns)."""
    cost = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for code in reversed(codes):
        cost = _before(cost, code)
    return cost


def walk(codes: str, state: int, after: np.ndarray, last: bool) -> tuple[str, int]:
    """Edits of a segment from a state on, the least in ASCII of the cheapest, and the state after
    it; after: the least cost from each state behind it."""
    costs = [after]
    for code in reversed(codes):
        costs.append(_before(costs[-1], code))
    costs.reverse()
    out, i = [], 0
    while i < len(codes) or last and state in (1, 2):
        letter, cost = _NEXT[state], costs[i][state]
        if i < len(codes) and costs[i + 1][state] + DELETE == cost:
            out.append("D")
            i += 1
        elif costs[i][_GO[state, letter]] + INSERT == cost:
            out.append("i" if letter == "u" else "I")
            state = _GO[state, letter]
        else:
            own, more = _class(codes[i]), (codes[i] in CUT_OFF) * TRUNCATED
            kept = _GO.get((state, own))
            if kept and costs[i + 1][kept] + more == cost:
                out.append("K")
                state = kept
            else:
                out.append("r" if letter == "u" else "R")
                state = _GO[state, letter]
            i += 1
    return "".join(out), state


def end_costs() -> np.ndarray:
    return np.array(_END, np.int64)


def _segment_costs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        yield p[["key", "low"]].assign(cost=[between(c).ravel().tolist() for c in p["codes"]])


def _costs_behind(p: pd.DataFrame) -> pd.DataFrame:
    """Of one conversation's segments, the least cost from each state behind each: a few numbers for thousands of rows."""
    p = p.sort_values("low")
    after, out = end_costs(), []
    for cost in reversed(p["cost"].tolist()):
        out.append(after.tolist())
        after = (np.array(cost).reshape(4, 4) + after).min(1)
    return p[["key", "low"]].assign(after=out[::-1], last=[*[False] * (len(p) - 1), True])


def _segment_walks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        rows = []
        for key, low, codes, after, last in zip(p["key"], p["low"], p["codes"], p["after"], p["last"]):
            for state in range(4):
                edits, to = walk(codes, state, np.array(after, np.int64), last)
                rows.append((key, low, state, to, edits, cost_of(codes, edits)))
        yield pd.DataFrame(rows, columns=["key", "low", "state", "to", "edits", "cost"])


def _states_in(p: pd.DataFrame) -> pd.DataFrame:
    """The state that each of one conversation's segments begins in."""
    out, state = [], 0
    for low, part in p.sort_values(["low", "state"]).groupby("low", sort=True):
        out.append((part["key"].iloc[0], low, state))
        state = int(part["to"].tolist()[state])
    return pd.DataFrame(out, columns=["key", "low", "state"])


def _short_edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of whole conversations, dealt out to the pieces that they stand in."""
    for batch in batches:
        rows = []
        for key, pieces in zip(batch["key"], batch["pieces"]):
            pieces = sorted((p["low"], p["codes"]) for p in pieces)
            edits, at = align("".join(c for _, c in pieces)), 0
            for k, (low, codes) in enumerate(pieces):
                end, seen = at, 0
                while seen < len(codes):
                    seen += edits[end] not in "iI"
                    end += 1
                end = len(edits) if k == len(pieces) - 1 else end
                rows.append((key, low, edits[at:end], cost_of(codes, edits[at:end])))
                at = end
        yield pd.DataFrame(rows, columns=["key", "low", "edits", "cost"])


# --- rows

def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults: of the hash of conv_id:turn modulo 20, 0 drops a row, 1 empties its
    text, 2 takes .!? out of it, 3 repeats it, 4 makes its role user. Nulls are one space, but that
    turn stays null where it orders rows."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def key_of(conv_id: str = "conv_id") -> Column:
    """A text for each conversation, for the null one too."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def order_rows(turns: DataFrame) -> DataFrame:
    """Rows in order, written once, with a number (place) that rises along each conversation: by turn,
    nulls first, then role, the first 64 characters of the text and its hash. Rows of one turn are
    dealt to several tasks if there are very many; equal ones by their places in the input.

    Adds key, kind (the role's initial), blank, ended (the last character but space is one of .!?) and hash.
    """
    text = F.col("text")
    ready = turns.select("conv_id", key_of().alias("key"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).withColumns(
        {"hash": F.sha2(text, 256), "head": F.substring("text", 1, 64), "at": F.monotonically_increasing_id()}
    )
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("hash"), F.col("at")]
    bare = F.rtrim(text, F.lit(_SPACE))
    sorted_ = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(sorted_.select(
        "conv_id", "key", "turn", "role", "text", "hash", F.monotonically_increasing_id().alias("place"),
        F.substring("role", 1, 1).alias("kind"), (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"),
    ))


def mark_faults(rows: DataFrame) -> DataFrame:
    """Rows with the first fault of each (blank, duplicate, truncated, or null): their places and codes.

    A text said before is found by the least place of each role and hash, so that no group of
    repeated rows comes together; its rows are joined by place, which no two share.
    """
    first = rows.where("not blank").groupBy("key", "role", "hash").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    kind = F.when(F.col("kind").isin("s", "u", "a"), F.col("kind")).otherwise("o")
    letters = F.when(fault.isNull(), kind).when(fault == "truncated", F.upper(kind)).otherwise(F.translate(kind, SOUND, DOOMED))
    return rows.drop("text", "hash").join(first, "place", "left").select("key", "place", fault.alias("fault"), letters.alias("code"))


def plan_edits(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of conversations (key, low, codes), and the edits of each (key, low, edits, cost).

    A piece is at most 4,096 rows of one conversation that stand together, low the first one's
    place. Conversations of up to 2,048 rows are aligned by a table each. Longer ones are aligned
    piece by piece over the four states of the grammar, with the same result: only 16 numbers of a
    piece meet those of the others.
    """
    piece = [F.shiftright("place", 33).alias("range"), F.floor(F.col("place").bitwiseAND((1 << 33) - 1) / PIECE).alias("piece")]
    listed = F.sort_array(F.collect_list(F.struct("place", "code")))
    pieces = cut(
        marked.groupBy("key", *piece).agg(listed.alias("l"))
        .select("key", F.col("l")[0]["place"].alias("low"), F.array_join(F.transform("l", lambda x: x["code"]), "").alias("codes"))
    )
    rows = pieces.groupBy("key").agg(F.sum(F.length("codes")).alias("rows"))
    sized = pieces.join(rows, "key")
    short = sized.where(F.col("rows") <= LONG).groupBy("key").agg(F.collect_list(F.struct("low", "codes")).alias("pieces"))
    edits = short.mapInPandas(_short_edits, "key string, low long, edits string, cost long")
    long = sized.where(F.col("rows") > LONG).select("key", "low", "codes")
    cost = long.mapInPandas(_segment_costs, "key string, low long, cost array<long>")
    behind = cost.groupBy("key").applyInPandas(_costs_behind, "key string, low long, after array<long>, last boolean")
    walks = cut(long.join(behind, ["key", "low"]).mapInPandas(_segment_walks, "key string, low long, state int, to int, edits string, cost long"))
    begun = walks.select("key", "low", "state", "to").groupBy("key").applyInPandas(_states_in, "key string, low long, state int")
    return pieces, cut(edits.unionByName(walks.join(begun, ["key", "low", "state"]).select("key", "low", "edits", "cost")))


def repair_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Repaired conversations: (conv_id, key, place, turn, token, lines), lines being the roles and
    texts that a row has become, with what is put in before or behind it; none if it is deleted."""
    each = edits.select("low", F.posexplode(F.regexp_extract_all("edits", F.lit(_TOKEN), F.lit(0))).alias("i", "token")).select((F.col("low") + F.col("i")).alias("place"), "token")
    line = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    user, assistant, text = F.lit("user"), F.lit("assistant"), F.col("text")
    one = lambda e: F.when(e == "i", line(user, F.lit(""))).when(e == "I", line(assistant, F.lit(""))).when(e == "K", line(F.col("role"), text)).when(e == "r", line(user, text)).when(e == "R", line(assistant, text))
    lines = F.transform(F.filter(F.split("token", ""), lambda e: (e != "") & (e != "D")), one)
    return rows.select("conv_id", "key", "place", "turn", "role", "text").join(each, "place").select("conv_id", "key", "place", "turn", "token", lines.alias("lines"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, as they come by; no conversation is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for i in range(batch.num_rows):
            own, said = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
            if own != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(said)
            else:
                state.update(b"\n" + said)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["key", "sha"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([state.hexdigest()], pa.string())], ["key", "sha"])


def text_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of role:text of the repaired rows, newline-joined, of each conversation that has any.
    A digest is of one text after the other, so a conversation is one task's stream here."""
    said = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    told = repaired.where(F.size("lines") > 0).select("key", "place", said.alias("said"))
    return told.repartition("key").sortWithinPartitions("key", "place").select("key", "said").mapInArrow(_digests, "key string, sha string")


def audit_conversations(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Faults, gaps, cheapest edits and repaired text of every conversation.

    turns: conv_id, turn, role, text; a null role or text is one space, a null conv_id a
    conversation too. every: rows whose conv_ids are all reported, those without turns with zeros.
    Equal rows of one turn are duplicates. Other columns are passed over; empty tables give no rows.
    """
    rows = order_rows(turns)
    marked = cut(mark_faults(rows))
    pieces, edits = plan_edits(marked)
    count = lambda f: F.count_if(F.col("fault") == f).alias(f)
    faults = marked.groupBy("key").agg(count("blank"), count("duplicate"), count("truncated"))
    long = lambda c: c.cast("decimal(38,0)")
    gaps = rows.groupBy("key", "turn").agg(F.lit(1).alias("_")).groupBy("key").agg((long(F.max("turn")) - long(F.min("turn")) + 1 - F.count("turn")).try_cast("long").alias("gaps"))
    steps = pieces.select("key", "low", F.translate("codes", CUT_OFF + DOOMED, SOUND + SOUND).alias("own"))
    # pairs inside a piece, and those of a piece's last row and the next one's first
    pairs = F.length("own") - 1 - sum((F.regexp_count("own", F.lit(f"{a}(?={b})")) for a, b in ("su", "ua", "au")), F.lit(0))
    ends = steps.groupBy("key").agg(F.sum(pairs).alias("inside"), F.sort_array(F.collect_list(F.struct("low", F.left("own", F.lit(1)).alias("a"), F.right("own", F.lit(1)).alias("b")))).alias("e"))
    seams = F.zip_with(F.slice("e", 1, F.size("e") - 1), F.slice("e", 2, F.size("e")), lambda x, y: F.concat(x["b"], y["a"]).isin(*_LEGAL))
    wrong = ends.select("key", (F.col("inside") + F.size(F.filter(seams, lambda x: ~x))).cast("long").alias("illegal"))
    audits = edits.groupBy("key").agg(F.sum("cost").alias("cost"), F.upper(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("low", "edits"))), lambda x: x["edits"]), "")).alias("audit"))
    digests = text_digests(repair_rows(rows, edits))
    out = (every if every is not None else turns).select("conv_id").distinct().withColumn("key", key_of())
    for part in (gaps, faults, wrong, audits, digests):
        out = out.join(part, "key", "left")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    return out.select("conv_id", zero("gaps"), zero("blank"), zero("duplicate"), zero("truncated"), zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
