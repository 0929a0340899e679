"""Structure repair of conversations over a suffix-shared DAWG.

Every row of a conversation becomes one letter: its role's initial (``s u a``, or ``o``
for any other) and its first fault (blank, duplicate, truncated, none).  A conversation
is its string of letters; letters of rows that have to be deleted are one and the same.
Distinct strings are sorted by their reversal, so strings with a common end lie next to
each other, and an acyclic word graph shared from the end is grown over them: one node
for every distinct suffix.  A node is worked out once for all conversations that pass
it: for each state of the grammar ``(s?(ua)+)?`` the cost to go, the edits up to the next
row and the state after them, the best audit going on at the node of the shorter suffix.
Nodes whose costs differ by a constant have the same edits, so each is one lookup in a
register of (letter, class of the next node).  Only nodes on the way from one range of
strings to the next are made twice.

Order of rows: turn (nulls first), then role, then SHA-256 of the text.  Edits and
costs: keep 0; rerole to user or assistant 3; delete 4, required for blank and duplicate
rows; insert a user or assistant row without text 3; a truncated row that stays adds 3.
Of equally cheap audits the least in ASCII order is taken: its first letter that differs
decides, as no two edits of one letter go to different states.

Rows travel without their texts until the audits are known.  Rows are dealt by ranges
of (conversation, turn, role, hash), so a conversation of any length is read in parts,
each part giving its letters; duplicates are found by a minimum per (conversation,
role, hash), joined back.  At last the texts of a conversation stream, in order, through
one task that holds nothing but the audit: a SHA-256 cannot be taken in parts.

Null role or text: one space (so the text is blank).  An empty role has no initial and
fits nowhere in the grammar.  A null ``conv_id`` is one
conversation.  Null turns come first and count for no gap; gaps beyond a long are null.
Repeated rows are duplicates of the first.  Only conv_id, turn, role and text are read.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from beatline.llm.common import materialize, small_batches

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3      # costs (fixed values)

#: Letters by fault, in the order of the initials s, u, a and any other.
LETTERS = {"": "suao", "truncated": "SUAO", "blank": "1234", "duplicate": "5678"}
DELETED = "x"

START, SYSTEM, USER, ASSISTANT = range(4)                  # states: the last role so far
NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
DUE = (USER, USER, ASSISTANT, USER)                        # what an inserted or changed row has to be
ROLE = {USER: "user", ASSISTANT: "assistant"}


# --- the automaton ------------------------------------------------------------------

#: A node: costs to go by state, and by state (edits up to the next row, state after them).
END = ((0, 2 * INSERT, INSERT, 0), (("", START), ("II", ASSISTANT), ("I", ASSISTANT), ("", ASSISTANT)))


@lru_cache(maxsize=None)
def _register(letter: str, after: tuple[int, ...]) -> tuple:
    """Costs and edits of a node from its letter and the costs of the next node, the least of them 0."""
    cut = CUT_OFF if letter.isupper() else 0

    def taken(state: int):
        yield DELETE + after[state], "D", state
        if letter != DELETED:
            kept, due = NEXT.get((letter.lower(), state)), DUE[state]
            if kept is not None:
                yield KEEP + cut + after[kept], "K", kept
            yield REROLE + cut + after[due], "R", due

    def found(state: int):
        for inserts in range(3):                           # a third one would come back to the state after the first
            for cost, edit, to in taken(state):
                yield INSERT * inserts + cost, "I" * inserts + edit, to
            state = DUE[state]

    best = [min(found(s)) for s in range(4)]
    return tuple(b[0] for b in best), tuple(b[1:] for b in best)


def node(letter: str, after: tuple) -> tuple:
    """The node of one more letter before the suffix of ``after``."""
    low = min(after[0])
    costs, edits = _register(letter, tuple(c - low for c in after[0]))
    return tuple(c + low for c in costs), edits


def shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def audits(reversals: Iterable[str]) -> Iterator[tuple[str, int, str]]:
    """(string, cost, audit) of each string, given as reversals in ascending order.

    ``path`` holds the nodes of the suffixes of the present string, shortest first;
    the next string keeps those of their common end.
    """
    path, last = [END], ""
    for r in reversals:
        del path[shared(last, r) + 1:]
        for letter in r[len(path) - 1:]:
            path.append(node(letter, path[-1]))
        state, out = START, []
        for _, edits in reversed(path):
            edit, state = edits[state]
            out.append(edit)
        yield r[::-1], path[-1][0][START], "".join(out)
        last = r


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = audits(r for b in batches for r in b.column(0).to_pylist())
    yield from _batches(found, 1000, word=pa.string(), cost=pa.int64(), audit=pa.string())


def word_audits(words: DataFrame) -> DataFrame:
    """(word, cost, audit) of distinct strings (column ``word``)."""
    r = F.reverse("word")
    return (words.select(r.alias("r")).repartitionByRange("r").sortWithinPartitions("r")
            .mapInArrow(_audits, "word string, cost long, audit string"))


# --- rows to letters ------------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows, each once, nulls replaced."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *filled, F.lit(1).alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """:func:`turns` with faults by crc32(``conv_id:turn``) % 20; a dropped row has 0 copies."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text, role = F.col("text"), F.col("role")
    return turns(conversations).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _hashed(rows: DataFrame) -> DataFrame:
    """Rows with the hash of the text, which stands for it in equality and order, and the faults of their own."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    return rows.select("*", F.sha2("text", 256).alias("hash"), (last == "").alias("is_blank"),
                       (~last.isin(*STOPS)).alias("is_cut"))


def _letter(initial: Column, fault: str) -> Column:
    out = F.lit(LETTERS[fault][3])
    for known, letter in zip("sua", LETTERS[fault]):
        out = F.when(initial == known, F.lit(letter)).otherwise(out)
    return out


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, hash, letters) per distinct row: a letter for each copy; none for a dropped one."""
    each = _hashed(rows).groupBy("conv_id", "turn", "role", "hash").agg(
        F.sum("copies").alias("n"), F.first("is_blank").alias("is_blank"), F.first("is_cut").alias("is_cut"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (each.where("n > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"))
             .agg(F.min(at).alias("first")))
    both = each.join(first, each["conv_id"].eqNullSafe(first["c"]) & (each["role"] == first["r"])
                     & (each["hash"] == first["h"]), "left")
    i = F.left("role", F.lit(1))
    own = F.when(F.col("is_cut"), _letter(i, "truncated")).otherwise(_letter(i, ""))
    again = _letter(i, "duplicate")
    n = F.col("n").cast("int")
    return both.select(
        "conv_id", "turn", "role", "hash",
        F.when(n == 0, F.lit("")).when(F.col("is_blank"), F.repeat(_letter(i, "blank"), n))
        .when(F.col("first").eqNullSafe(at), F.concat(own, F.repeat(again, n - 1)))
        .otherwise(F.repeat(again, n)).alias("letters"))


def _batches(rows: Iterator[tuple], size: int, **kinds: pa.DataType) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*some), kinds.values())], names=list(kinds))


def _segments(conv_id: pa.DataType):
    """Letters and turns of each conversation in a range of rows."""
    def segment(conv, group) -> tuple:
        letters, first, last, n = [], None, None, 0
        for _, turn, word in group:
            letters.append(word)
            if word and turn is not None and turn != last:
                first, last, n = (turn if first is None else first), turn, n + 1
        return conv, TaskContext.get().partitionId(), "".join(letters), first, last, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        found = (segment(c, g) for c, g in itertools.groupby(rows, key=lambda r: r[0]))
        yield from _batches(found, 2000, conv_id=conv_id, part=pa.int32(), letters=pa.string(), first=pa.int64(),
                            last=pa.int64(), n=pa.int64())
    return run


def _without(text: Column, letters: str) -> Column:
    """How many of the letters stand in ``text``."""
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def _kind(rows: DataFrame) -> tuple[str, pa.DataType]:
    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def structure(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, word: the faults and the letters of every conversation."""
    kind, arrow = _kind(rows)
    order = ["conv_id", "turn", "role", "hash"]
    segments = (_letters(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "letters")
                .mapInArrow(_segments(arrow), f"conv_id {kind}, part int, letters string, first long, last long, n long"))
    each = segments.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "letters", "first", "last", "n"))).alias("parts"))
    seen = F.filter("parts", lambda p: p["first"].isNotNull())
    each = each.select("conv_id", F.array_join("parts.letters", "").alias("letters"), seen.alias("seen"))
    steps = F.zip_with(F.slice("seen", 2, F.greatest(F.size("seen"), F.lit(1))), F.col("seen"),
                       lambda b, a: F.when(b["first"] == a["last"], 1).otherwise(0))
    known = F.aggregate("seen", F.lit(0).cast("long"), lambda s, p: s + p["n"]) - F.aggregate(
        steps, F.lit(0).cast("long"), lambda s, x: s + x)
    wide = [F.array_max("seen.last").cast("decimal(20,0)"), F.array_min("seen.first").cast("decimal(20,0)")]
    gaps = F.when(F.size("seen") == 0, F.lit(0).cast("long")).otherwise(
        (wide[0] - wide[1] + 1 - known).try_cast("long"))
    faults = "".join(LETTERS["blank"] + LETTERS["duplicate"])
    roles = F.translate("letters", "".join(LETTERS.values()), "suao" * 4)
    pairs = sum((F.length(roles) - F.length(F.replace(roles, F.lit(p), F.lit("")))) / 2 for p in ("su", "ua", "au"))
    return each.select(
        "conv_id", gaps.alias("gaps"),
        *[_without(F.col("letters"), LETTERS[f]).alias(f) for f in ("blank", "duplicate", "truncated")],
        (F.greatest(F.length("letters") - 1, F.lit(0)) - pairs).cast("long").alias("illegal"),
        F.translate("letters", faults, DELETED * len(faults)).alias("word"))


def plans(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation of :func:`turns` rows."""
    found = materialize(structure(rows), "structure")
    best = word_audits(found.select("word").distinct())
    return found.join(best, "word").drop("word")


# --- applying the edits ----------------------------------------------------------------

def edited(audit: str, rows: Iterable[tuple]) -> Iterator[tuple]:
    """(turn, role, text, edit) of the repaired conversation from its (turn, role, text, copies) rows in order."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while audit[at:at + 1] == "I":
            state, at = DUE[state], at + 1
            yield None, ROLE[state], "", "I"

    for turn, role, text, copies in rows:
        for _ in range(copies):
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = NEXT[role[:1], state]
                yield turn, role, text, edit
            elif edit == "R":
                state = DUE[state]
                yield turn, ROLE[state], text, edit
    yield from inserted()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, rows) of every conversation: the head comes first, then the rows stream."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for _, group in itertools.groupby(rows, key=lambda r: r[0]):
        head = next(group)
        yield head, ((turn, role, text, copies) for _, _, turn, role, text, copies, *_ in group)


def _dealt(rows: DataFrame, planned: DataFrame, more: list[str]) -> DataFrame:
    """Heads (audit and ``more``) and rows, dealt by conversation, in order."""
    own = ["turn", "role", "text", "copies"]
    body = _hashed(rows).where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.when(F.col("is_blank"), F.lit("")).otherwise(F.col("text")).alias("text"),
        "copies", "hash")
    heads = planned.select("conv_id", F.lit(0).alias("kind"), *more, "audit")
    return (small_batches(body.unionByName(heads, allowMissingColumns=True)).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "role", "hash")
            .select("conv_id", "kind", *own, *more, "audit"))


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _digests(conv_id: pa.DataType):
    def one(head, rows):
        sha, between = hashlib.sha256(), b""
        for _, role, text, _ in edited(head[-1], rows):
            sha.update(between + f"{role}:{text}".encode())
            between = b"\n"
        return head[0], *head[6:], sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((one(*c) for c in _conversations(batches)), 1000, conv_id=conv_id,
                            **{c: pa.int64() for c in REPORT}, audit=pa.string(), repaired_sha256=pa.string())
    return run


def digest(rows: DataFrame) -> DataFrame:
    """conv_id, the faults, cost, audit and SHA-256 of the repaired ``role:text`` lines of every conversation."""
    kind, arrow = _kind(rows)
    return _dealt(rows, plans(rows), REPORT).mapInArrow(
        _digests(arrow), f"conv_id {kind}, {', '.join(f'{c} long' for c in REPORT)}, audit string, repaired_sha256 string")


def _repairs(conv_id: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((head[0], at, *row) for head, rows in _conversations(batches)
                 for at, row in enumerate(edited(head[-1], rows)))
        yield from _batches(found, 500, conv_id=conv_id, place=pa.int64(), turn=pa.int64(), role=pa.string(),
                            text=pa.string(), edit=pa.string())
    return run


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, text, edit (K, R or I): the rows of the repaired conversations."""
    kind, arrow = _kind(rows)
    return _dealt(rows, plans(rows), []).mapInArrow(
        _repairs(arrow), f"conv_id {kind}, place long, turn long, role string, text string, edit string")


#: The same by plain row-wise SQL: costs and whole audits per conversation from its last row back.
ORACLE = r"""
with recursive base as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') k from conversations),
kinds as (
  select conv_id, turn, role, text, xor(list_reduce(
    list_concat([4294967295::bigint], list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint) % 20 kind from base),
dam as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) copy from kinds),
placed as (
  select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) r
  from dam),
num as (
  select conv_id, turn, role, text, r, row_number() over (partition by conv_id, role, text order by r) again,
    not regexp_matches(text, '[^\x20\x09-\x0D]') is_blank,
    right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) not in ('.', '!', '?') is_cut from placed),
row1 as (
  select conv_id, turn, role, text, r, is_blank, not is_blank and again > 1 is_dup,
    not is_blank and again = 1 and is_cut is_cut, left(role, 1) i,
    lag(left(role, 1)) over (partition by conv_id order by r) before from num),
faults as (
  select conv_id, case when count(turn) = 0 then 0 else try_cast(max(turn)::hugeint - min(turn) + 1 - count(distinct turn) as bigint) end gaps,
    count(*) filter (where is_blank) blank, count(*) filter (where is_dup) duplicate, count(*) filter (where is_cut) truncated,
    count(*) filter (where r > 1 and before || i not in ('su', 'ua', 'au')) illegal, max(r) n from row1 group by conv_id),
dp(conv_id, r, v) as (
  select conv_id, n, [{'c': 0::bigint, 's': ''}, {'c': 6::bigint, 's': 'II'}, {'c': 3::bigint, 's': 'I'}, {'c': 0::bigint, 's': ''}]
  from faults
  union all
  select conv_id, r - 1, list_transform([1, 2, 3, 4], lambda st: list_sort([
      cons[st], {'c': 3 + cons[[3, 3, 4, 3][st]].c, 's': 'I' || cons[[3, 3, 4, 3][st]].s},
      {'c': 6 + cons[[4, 4, 3, 4][st]].c, 's': 'II' || cons[[4, 4, 3, 4][st]].s}])[1])
  from (
    select d.conv_id, d.r, list_transform([1, 2, 3, 4], lambda st: list_sort(list_filter([
        {'c': 4 + v[st].c, 's': 'D' || v[st].s},
        {'c': (case when is_blank or is_dup then null when is_cut then 3 else 0 end) + case
            when i = 's' and st = 1 then v[2].c when i = 'u' and st <> 3 then v[3].c when i = 'a' and st = 3 then v[4].c end,
         's': 'K' || case i when 's' then v[2].s when 'u' then v[3].s else v[4].s end},
        {'c': (case when is_blank or is_dup then null when is_cut then 6 else 3 end) + v[[3, 3, 4, 3][st]].c,
         's': 'R' || v[[3, 3, 4, 3][st]].s}], lambda x: x.c is not null))[1]) cons
    from dp d join row1 w on d.conv_id is not distinct from w.conv_id and d.r = w.r)),
best as (select conv_id, v[1].c cost, v[1].s audit from dp where r = 0),
letters as (
  select conv_id, k, audit[k] e, len(regexp_replace(audit[:k], 'I', '', 'g')) r,
    len(regexp_replace(audit[:k], 'D', '', 'g')) p, len(regexp_extract(audit, '^D*')) + 1 head
  from (select conv_id, audit, unnest(range(1, len(audit) + 1)) k from best)),
lines as (
  select l.conv_id, l.k, l.p, l.e, w.role, case when l.e = 'I' then '' else w.text end as text,
    first_value(l.e = 'K' and w.i = 's') over (partition by l.conv_id order by l.p, l.e <> 'D' desc) led
  from letters l left join row1 w on l.conv_id is not distinct from w.conv_id and l.r = w.r and l.e <> 'I' where l.e <> 'D'),
texts as (
  select conv_id, string_agg(case when e = 'K' then role when (p % 2 = 1) <> led then 'user' else 'assistant' end
    || ':' || text, chr(10) order by k) t from lines group by conv_id)
select b.conv_id, case when f.n is null then 0 else f.gaps end gaps, coalesce(f.blank, 0) blank, coalesce(f.duplicate, 0) duplicate,
  coalesce(f.truncated, 0) truncated, coalesce(f.illegal, 0) illegal, coalesce(z.cost, 0) cost, coalesce(z.audit, '') audit,
  sha256(coalesce(t.t, '')) repaired_sha256
from (select distinct conv_id from conversations) b left join faults f on b.conv_id is not distinct from f.conv_id
left join best z on b.conv_id is not distinct from z.conv_id left join texts t on b.conv_id is not distinct from t.conv_id
"""
