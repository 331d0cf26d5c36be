"""Personal data in texts: fixed patterns, and identifiers found by bootstrapped contexts.

Base patterns give seed entities. The words before an entity are its lexical pattern.
Patterns and the strings they introduce form a graph, scored in turns by Spark: a
pattern is as reliable as the strings it introduces, a string as its best patterns.
Reliable patterns then name strings that look like identifiers but match no base
pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, saved, texts

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Each is written so that a text takes time in proportion to its length.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: What may be an identifier beside the base patterns: a spelled-out address, or a run with five digits or more.
LIKELY = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9.-]+"
    r"|\+?\(?[0-9](?:[\x20()./-]?[0-9A-Z]){4,}+"
)
LEAD = 48
LEAD_WORD = re.compile(r"[^\W\d_]+[:#=]?|[:#=]")
#: A pattern needs so many different seed strings.
MIN_SEEDS = 20
MIN_SCORE = 0.8
ROUNDS = 4
#: Up to so many patterns every task gets all of them; of more, each text gets its own by a join.
FEW_PATTERNS = 1 << 16

Span = tuple[int, int, str]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[Span]:
    """Around each @, the longest name that no earlier match took, if a domain follows."""
    at, taken = text.find("@"), 0
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            taken = domain.end()
            yield start, taken, "email"
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then by kind as listed."""
    spans = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = _only_digits(m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_only_digits(m.group())) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def lead_of(text: str, start: int) -> str | None:
    """The lexical pattern: the last two words before a place on its line, a mark like : or = kept."""
    before = text[max(0, start - LEAD) : start].rpartition("\n")[2]
    if start > LEAD and before == text[start - LEAD : start]:
        before = before.partition(" ")[2]  # the first word may be cut
    words = LEAD_WORD.findall(before)[-2:]
    return " ".join(words).lower() if words else None


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Likely identifiers that touch no base span, each as long as it goes on, with their lexical pattern."""
    starts = [a for a, _, _ in base]
    ends = list(accumulate((b for _, b, _ in base), max))
    # Each gap between base spans for itself, so that a run that meets one keeps what lies before and after.
    for at, end in zip([0, *ends], [*starts, len(text)]):
        for m in LIKELY.finditer(text, at, max(at, end)):
            if sum(c in "0123456789" for c in m.group()) < 5 and "at" not in m.group().lower():
                continue
            lead = lead_of(text, m.start())
            if lead:
                yield m.start(), m.end(), lead


def _may_hold(text: str) -> bool:
    return "@" in text or "(at)" in text.lower() or "[at]" in text.lower() or re.search("[0-9]", text) is not None


def _instances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        rows = []
        for text in texts(batch.column(0)):
            if not _may_hold(text):
                continue
            base = base_spans(text)
            rows += [(lead, text[a:b], k) for a, b, k in base if (lead := lead_of(text, a))]
            rows += [(lead, text[a:b], None) for a, b, lead in candidates(text, base)]
        lead, string, kind = zip(*rows) if rows else ((), (), ())
        columns = [pa.array(c, pa.string()) for c in (lead, string, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["lead", "string", "kind"])


def pattern_table(docs: DataFrame, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """lead, lead_kind: lexical patterns that the graph finds reliable, as a saved table. All documents count."""
    found = mapped(docs.select("text"), _instances, "lead string, string string, kind string")
    edges = saved(found.groupBy("lead", "string").agg(F.max("kind").alias("kind")), "pattern-strings")
    seeds = edges.filter("kind is not null")
    support = seeds.groupBy("lead", "kind").count().filter(F.col("count") >= min_seeds)
    kinds = support.groupBy("lead").agg(F.max(F.struct("count", "kind"))["kind"].alias("lead_kind"))
    graph = saved(edges.join(kinds, "lead"), "pattern-graph")
    scores = graph.select("lead", "string", F.col("kind").isNotNull().cast("double").alias("score"))
    for _ in range(ROUNDS):
        patterns = scores.groupBy("lead").agg((F.sum("score") / (F.count("*") + 1)).alias("trust"))
        trusted = graph.join(patterns, "lead")
        # Noisy or over the patterns of a string; seeds stay certain.
        doubt = trusted.groupBy("string").agg(
            F.sum(F.log1p(-F.least(F.col("trust"), F.lit(0.999)))).alias("doubt"), F.max("kind").alias("seed")
        )
        score = F.when(F.col("seed").isNotNull(), 1.0).otherwise(1 - F.exp("doubt"))
        scores = saved(graph.select("lead", "string").join(doubt.select("string", score.alias("score")), "string"), "scores")
    patterns = scores.groupBy("lead").agg((F.sum("score") / (F.count("*") + 1)).alias("trust"))
    chosen = patterns.filter(F.col("trust") >= min_score).join(kinds, "lead")
    return saved(chosen.select("lead", "lead_kind"), "patterns")


def _as_dict(patterns: DataFrame) -> dict[str, str]:
    return {row["lead"]: row["lead_kind"] for row in patterns.collect()}


def reliable_patterns(docs: DataFrame, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> dict[str, str]:
    """The patterns of ``pattern_table`` as a dict, for callers whose driver can hold all of them."""
    return _as_dict(pattern_table(docs, min_seeds, min_score))


OWN_PATTERNS, TEXT_KEY = "_own_patterns", "_text_key"


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            found = {lead for _, _, lead in candidates(text, base_spans(text))} if _may_hold(text) else ()
            rows += [(key, lead) for lead in found]
        key, lead = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(lead, pa.string())], names=["key", "lead"])


def _with_patterns(docs: DataFrame, patterns: dict[str, str] | DataFrame | None) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with a last column of the patterns a text needs, null if it needs none or all get the same dict."""
    ddl = "array<struct<lead:string,lead_kind:string>>"
    if patterns is None:
        patterns = pattern_table(docs)
    if isinstance(patterns, DataFrame):
        if patterns.count() > FEW_PATTERNS:
            keyed = docs.withColumn(TEXT_KEY, F.sha2("text", 256))
            leads = mapped(keyed.select(TEXT_KEY, "text"), _leads, "key string, lead string").distinct()
            own = leads.join(patterns, "lead").groupBy("key").agg(F.collect_list(F.struct("lead", "lead_kind")).alias(OWN_PATTERNS))
            own = saved(own, "own-patterns")
            return keyed.join(own, F.col(TEXT_KEY) == F.col("key"), "left").drop("key", TEXT_KEY), {}
        patterns = _as_dict(patterns)
    return docs.withColumn(OWN_PATTERNS, F.lit(None).cast(ddl)), patterns


def _spans_of(batch: pa.RecordBatch, at: int, patterns: dict[str, str]) -> Iterator[tuple[str | None, list[Span], list[Span]]]:
    """Text of column ``at``, base spans, and all spans of every row; the last column holds a text's own patterns."""
    for text, own in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
        known = {p["lead"]: p["lead_kind"] for p in own} if own else patterns
        yield text, *all_spans(text or "", known)


def all_spans(text: str, patterns: dict[str, str]) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and learned spans by start, then by kind as listed."""
    if not _may_hold(text):
        return [], []
    base = base_spans(text)
    learned = [(a, b, patterns[lead]) for a, b, lead in candidates(text, base) if lead in patterns] if patterns else []
    return base, sorted(base + learned, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_personal_data(docs: DataFrame, patterns: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans for every row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, joined by commas. The counts
    and ``base_spans`` hold the base patterns' spans, ``spans`` the learned ones too.
    Null and empty texts have none, repeated rows give repeated results, a null doc_id
    stays null, other columns are left out and an empty table gives an empty one.
    ``patterns`` may be a dict, a table as of ``pattern_table``, or are learned from ``docs``.
    """
    docs, known = _with_patterns(docs.select(F.col("doc_id").cast("long"), "text"), patterns)
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = [spans for _, *spans in _spans_of(batch, 1, known)]
            counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            joined = [pa.array([_joined(spans[i]) for spans in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *joined], names=names)

    ddl = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string"
    return mapped(docs, run, ddl)


def masked(text: str, spans: list[Span]) -> str:
    """Replaces spans by their kind; overlapping spans become one, of the first one's kind."""
    parts, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def mask_personal_data(docs: DataFrame, patterns: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind in brackets; a null text stays null."""
    rows, known = _with_patterns(docs, patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            at = batch.schema.get_field_index("text")
            found = [None if text is None else masked(text, spans) for text, _, spans in _spans_of(batch, at, known)]
            batch = batch.set_column(at, "text", pa.array(found, pa.string()))
            yield batch.select(range(batch.num_columns - 1))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return mapped(rows, run, ddl)
