"""Chat formatting: conversations as windows of whole turns within a budget of tokens."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .tokens import encoder

#: The marks of this template, and the strings that end or open turns in common ones.
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: Tokens counted for the marks around a turn.
MARKS = 4
_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
_ESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """The text with a backslash before each backslash and inside each control string, so that none is left."""
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def escape_role(role: str) -> str:
    """As escape(), and a line end becomes backslash and L, since the role ends with its line."""
    return escape(role).replace("\n", "\\L")


def unescape_role(role: str) -> str:
    return _ESCAPE.sub(lambda m: "\n" if m[1] == "L" else m[1], role)


def parse(formatted: str) -> list[tuple[str, str]]:
    """role and text of every turn in a formatted window."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest[: rest.rindex(END)])))
    return turns


class Formatter:
    """Windows of one conversation, turn by turn; what is held is one window, the system turn and the history."""

    def __init__(self, conv_id, budget: int, history: int, history_budget: int, target: str):
        self.conv_id, self.budget, self.history, self.history_budget, self.target = conv_id, budget, history, history_budget, target
        self.system: tuple[str, str, int] | None = None
        self.past: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.base: list[tuple[str, str, int]] = []
        self.turns = self.windows = 0
        #: Tokens of all turns so far (but the system's), and of those before the window's base and first new turn.
        self.prefix = self.opened = 0

    def add(self, role: str, text: str, cost: int) -> Iterator[dict]:
        turn = (role, text, cost)
        self.turns += 1
        if self.turns == 1 and role == "system":
            self.system = turn
            return
        fixed = self.system[2] if self.system else 0
        if self.new and fixed + sum(x[2] for x in self.base) + self.prefix + cost - self.opened > self.budget:
            yield self.window()
            self.past = (self.past + self.new)[-self.history :] if self.history else []
            kept, total = [], 0
            for x in reversed(self.past):
                total += x[2]
                if total > self.history_budget:
                    break
                kept.insert(0, x)
            if fixed + sum(x[2] for x in kept) + cost > self.budget:
                kept = []
            self.base, self.new, self.opened = kept, [], self.prefix
        self.new.append(turn)
        self.prefix += cost

    def window(self) -> dict:
        first = self.windows == 0
        turns = [*([self.system] if self.system else []), *self.base, *self.new]
        repeated = 0 if first else len(turns) - len(self.new)
        out, at, mask = [], 0, []
        for i, (role, text, _) in enumerate(turns):
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            if i >= repeated and role == self.target:
                mask.append({"start": at + len(head), "end": at + len(head) + len(body)})
            out += [head, body, END, "\n"]
            at += len(head) + len(body) + len(END) + 1
        tokens = sum(x[2] for x in turns)
        self.windows += 1
        return {"conv_id": self.conv_id, "window": self.windows - 1, "formatted": "".join(out), "n_repeated": repeated, "mask": mask, "tokens": tokens, "over_budget": tokens > self.budget}

    def close(self) -> Iterator[dict]:
        if self.new or (self.system and not self.windows):
            yield self.window()


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_WINDOW = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()), ("n_repeated", pa.int64()), ("mask", pa.list_(_SPAN)), ("tokens", pa.int64()), ("over_budget", pa.bool_())])
WINDOWS = "conv_id long, window long, formatted string, n_repeated long, mask array<struct<start:long,end:long>>, tokens long, over_budget boolean"
#: Characters of windows sent to Spark at once.
_FLUSH = 4_000_000


def _format(batches: Iterator[pa.RecordBatch], budget: int, history: int, history_budget: int, target: str, tokenizer: str | None) -> Iterator[pa.RecordBatch]:
    now, rows, size = None, [], 0
    for batch in batches:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        if tokenizer is None:
            costs = [len(_SPACE.findall(x)) for x in texts]
        else:
            costs = encoder(tokenizer).encode_column(pa.array(texts, pa.string()))[1].tolist()
        for conv, role, text, cost in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), texts, costs):
            if now is None or now.conv_id != conv:
                rows += now.close() if now else ()
                now = Formatter(conv, budget, history, history_budget, target)
            made = list(now.add(role or "", text, cost + MARKS))
            rows += made
            size += len(text)
            if size > _FLUSH:
                yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW)
                rows, size = [], 0
    rows += now.close() if now else ()
    yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW)


def windows(conversations: DataFrame, budget: int = 512, history: int = 2, history_budget: int = 128, target: str = "assistant", tokenizer: str | None = None) -> DataFrame:
    """Each conversation (conv_id, turn, role, text) as formatted windows.

    A window holds the system turn (the first, if its role is system), up to `history` turns from before
    (history_budget tokens at most, and none where the next turn wouldn't fit beside them), and as many new
    turns as the budget allows by the turns' prefix sums; one at least, so that a turn over the budget has a window
    of its own, marked over_budget.  No turn is cut or dropped.  mask: the character spans of the texts to be learned, the
    target role's new turns; repeated turns are not in it.  n_repeated: how many turns at the window's start
    were in an earlier one.  Tokens are words, or a tokenizer file's ids; MARKS more for each turn.

    Turns are in order of turn (nulls first), then role and text where turns repeat.  A null text or role counts as
    empty; rows without a conv_id are one conversation.  Empty conversations: an empty result.  Rows are
    sorted within a task and read as a stream: memory holds one window, however long a conversation is.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(lambda it: _format(it, budget, history, history_budget, target, tokenizer), WINDOWS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, state, done = None, None, []

    def close():
        if state:
            done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for batch in batches:
        for conv, text, repeated, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "n_repeated", "mask"))):
            if state is None or now != conv:
                close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[4] += len(text)
            for role, said in parse(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for span in mask:
                learned = unescape(text[span["start"] : span["end"]])
                state[2] += len(learned)
                state[3].update(learned.encode())
        if done:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
    close()
    if done:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """What windows() wrote, read back: each conversation's turns and learned text as counts and digests."""
    rows = formatted.select("conv_id", "window", "formatted", "n_repeated", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return rows.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def digests_sql(budget: int = 512, history_budget: int = 128) -> str:
    """The rows of digests(windows()), with words for tokens and a history of two turns."""
    marks = len(START) + len(END) + 2
    return f"""
with recursive said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
each as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
                len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + {MARKS} as cost,
                len(replace({_escaped_sql("role")}, chr(10), '\\L')) + len({_escaped_sql("text")}) + {marks} as chars from said),
whole as (select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
                 coalesce(sum(len(text)) filter (role = 'assistant'), 0) as loss_chars,
                 sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
                 max(case when i = 1 and role = 'system' then cost else 0 end) as sys_cost,
                 max(case when i = 1 and role = 'system' then chars else 0 end) as sys_chars,
                 coalesce(list(cost order by i) filter (i > 1 or role <> 'system'), []) as c,
                 coalesce(list(chars order by i) filter (i > 1 or role <> 'system'), []) as n from each group by conv_id),
steps as (
  select conv_id, 0 as s, 0 as e, sys_cost, sys_chars, c, n, 0::bigint as chars from whole
  union all
  select conv_id, e, (select max(x) from (select unnest(range(e + 1, len(c) + 1)) as x)
                      where x = e + 1 or sys_cost + h_cost + list_sum(c[e + 1:x]) <= {budget}),
         sys_cost, sys_chars, c, n, h_chars
  from (select *, case when fits then coalesce(list_sum(c[e - h + 1:e]), 0) else 0 end as h_cost,
                  case when fits then coalesce(list_sum(n[e - h + 1:e]), 0) else 0 end as h_chars
        from (select *, sys_cost + coalesce(list_sum(c[e - h + 1:e]), 0) + c[e + 1] <= {budget} as fits
              from (select *, case when e >= 2 and c[e - 1] + c[e] <= {history_budget} then 2
                                   when e >= 1 and c[e] <= {history_budget} then 1 else 0 end as h
                    from steps where e < len(c))))),
totals as (select conv_id, cast(sum(case when e > s then chars + coalesce(list_sum(n[s + 1:e]), 0) + sys_chars
                                         when len(c) = 0 then sys_chars else 0 end) as bigint) as formatted_chars from steps group by conv_id)
select conv_id, n_turns, turns_sha256, cast(loss_chars as bigint) as loss_chars, loss_sha256, formatted_chars from whole join totals using (conv_id)
"""
