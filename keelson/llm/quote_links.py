"""Operator 6: quotation linking, conversations in reply order without quotes.

A message's lines are read by quote level (the number of leading ``>`` marks);
lines of one level between blank lines are a passage, and an attribution line above a
quote belongs to it. Passages and the messages' own text are cut into the
same units (whole, paragraph, line, sentence), normalised (ASCII lower case,
one blank between words) and hashed. The original of a unit is the earliest
message of the conversation that has it in its own text, so the equi-join on
(conversation, hash) finds one original per unit, however often it recurs. A
message replies to the original with the most quoted words on its lowest
matched level; following the links up (by pointer jumping) gives the thread.
A conversation runs by thread start, then by turn: a reply stands behind what
it replies to.

Defined results: a null text is empty; a message whose quotes match nothing, or
only later messages, starts a thread; a null conversation is one of its own;
null turns come last and link with nothing; messages that share a turn are ordered by text;
unquoted text is kept whole (lines end at line feeds, other signs stay), outer blank
lines are cut; messages of any length are read whole; a short quoted line links like a
long one where nothing longer matches; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import source_key, stash
from keelson.operators.rank import rank_within_groups

# Units of fewer words say little: they link only where a message has no longer match,
# unless they are a whole text.
LEAST_WORDS = 3

_MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
# How mail programs close the line above a quote.
_ATTRIBUTION = re.compile(r"(?:wrote|writes|said|schrieb|écrit|escribió|ha scritto)\s*:\s*$", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_quotes(text: str) -> tuple[str, list[tuple[int, str]]]:
    """Own text of a message, and its quoted passages as (level, text)."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in text.split("\n"):
        m = _MARKS.match(line)
        level = m.group(1).count(">") if m else 0
        rest = line[m.end():] if m else line
        if level == 0:
            own.append(line)
        elif rest.strip():
            if last == 0:
                _drop_attribution(own)
            if last == 0 or level != passages[-1][0]:
                passages.append((level, []))
            passages[-1][1].append(rest)
        elif last == 0:
            _drop_attribution(own)
            passages.append((level, []))
        elif level == passages[-1][0]:
            passages[-1][1].append("")
        last = level
    quoted = [(n, "\n".join(lines).strip("\n")) for n, lines in passages]
    return "\n".join(own).strip("\n"), [(n, part) for n, part in quoted if part]


def _drop_attribution(own: list[str]) -> None:
    while own and not own[-1].strip():
        own.pop()
    if own and _ATTRIBUTION.search(own[-1]):
        own.pop()


def units(text: str) -> dict[int, int]:
    """Hash of every unit of ``text``, with its number of words, negative if it is short."""
    out = {}

    def add(part: str, whole: bool = False) -> None:
        words = part.translate(_UPPER).split()
        if words:
            size = len(words) if whole or len(words) >= LEAST_WORDS else -len(words)
            digest = hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=8).digest()
            out.setdefault(int.from_bytes(digest, "little", signed=True), size)

    add(text, whole=True)
    for paragraph in re.split(r"\n\s*\n", text):
        add(paragraph)
        for line in paragraph.split("\n"):
            add(line)
        for sentence in _SENTENCE.split(" ".join(paragraph.split())):
            add(sentence)
    return out


_UNIT = pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("words", pa.int32())])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies, quotes, own = [], [], []
        for text in batch.column("text").to_pylist():
            body, passages = split_quotes(text or "")
            bodies.append(body)
            quotes.append([{"level": n, "hash": h, "words": w} for n, part in passages for h, w in units(part).items()])
            own.append([{"level": 0, "hash": h, "words": w} for h, w in units(body).items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv_id", "turn", "role")]
            + [pa.array(bodies, pa.string()), pa.array(quotes, pa.list_(_UNIT)), pa.array(own, pa.list_(_UNIT))],
            ["conv_id", "turn", "role", "body", "quotes", "own"])


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message, without its quotes and with its place in the conversation.

    ``conv_id, turn, role, body, n_quoted, reply_to, thread, depth, position``:
    ``reply_to`` is the turn replied to, ``thread`` the turn that starts the
    thread, ``depth`` the links up to it, ``position`` counts from 1.
    """
    types = {f.name: f.dataType.simpleString() for f in messages.schema}
    unit = "array<struct<level:int,hash:bigint,words:int>>"
    parsed = messages.select("conv_id", "turn", "role", "text").mapInArrow(
        _parse, f"conv_id {types['conv_id']}, turn {types['turn']}, role {types['role']}, body string, quotes {unit}, own {unit}")
    rows = stash(parsed.withColumn("conv", source_key("conv_id")), "quotes-rows").withColumn("uid", F.monotonically_increasing_id())
    rows = stash(rows, "quotes-ids")
    links = stash(_links(rows), "quotes-links")
    threads = _threads(links)
    known = rows.select("uid", "conv", "conv_id", "turn", "role", "body", F.size("quotes").alias("n_quoted"))
    placed = known.join(threads.withColumnsRenamed({"conv": "__c", "turn": "__t"}),
                        (F.col("conv") == F.col("__c")) & (F.col("turn") == F.col("__t")), "left").drop("__c", "__t")
    placed = placed.withColumns({"thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0)),
                                 "last": F.col("turn").isNull()})
    ranked = rank_within_groups(stash(placed, "quotes-placed"), ["conv"], ["last", "thread", "turn", "body", "uid"], rank_col="position")
    return ranked.select("conv_id", "turn", "role", "body", "n_quoted", "reply_to", "thread", "depth", "position")


def _links(rows: DataFrame) -> DataFrame:
    """``conv, turn, reply_to`` of the messages whose quotes have an earlier original."""
    quotes = (rows.filter("size(quotes) > 0 and turn is not null")
              .select("conv", "uid", "turn", F.explode("quotes").alias("q")).select("conv", "uid", "turn", "q.*"))
    # Only units that somebody quotes can be originals.
    wanted = quotes.select("conv", "hash").distinct()
    originals = (rows.filter("turn is not null").select("conv", "turn", F.explode("own").alias("o"))
                 .select("conv", "turn", "o.hash").join(wanted, ["conv", "hash"], "left_semi")
                 .groupBy("conv", "hash").agg(F.min("turn").alias("at")))
    originals = stash(originals, "quotes-originals")
    hits = quotes.join(originals, ["conv", "hash"]).filter(F.col("at") < F.col("turn"))
    long, short = (F.sum(F.greatest(c, F.lit(0))) for c in (F.col("words"), -F.col("words")))
    score = hits.groupBy("conv", "uid", "turn", "level", "at").agg(long.alias("long"), short.alias("short"))
    # Originals of long units go before those of short ones alone.
    best = score.groupBy("conv", "uid", "turn").agg(F.max(F.struct(
        F.col("long") > 0, -F.col("level"), F.when(F.col("long") > 0, F.col("long")).otherwise(F.col("short")), "at")).alias("b"))
    # Messages that share a turn share the link, as links name turns.
    return best.groupBy("conv", "turn").agg(F.max("b.at").alias("reply_to"))


def _threads(links: DataFrame) -> DataFrame:
    """``conv, turn, reply_to, thread, depth`` by pointer jumping."""
    state = links.select("conv", "turn", "reply_to", F.col("reply_to").alias("thread"), F.lit(1).alias("depth"))
    while True:
        up = state.select(F.col("conv").alias("__c"), F.col("turn").alias("__t"), F.col("thread").alias("__up"),
                          F.col("depth").alias("__d"))
        joined = state.join(up, (F.col("conv") == F.col("__c")) & (F.col("thread") == F.col("__t")), "left")
        state = stash(joined.select("conv", "turn", "reply_to", F.coalesce("__up", "thread").alias("thread"),
                                    (F.col("depth") + F.coalesce("__d", F.lit(0))).alias("depth"),
                                    F.col("__up").isNotNull().alias("moved")), "quotes-threads")
        moved = not state.filter("moved").isEmpty()
        state = state.drop("moved")
        if not moved:
            return state
