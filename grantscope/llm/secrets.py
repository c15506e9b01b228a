"""Secret scans by multipart credential linking, in DataFrame functions only.

Base findings stand alone: assignments to a telling name, access-key identifiers, long hexadecimal strings. Weak
findings (login identifiers, mixed random strings, service addresses) are only candidates: each is reported when a
complementary part lies in the same scope (a block of text between blank lines), however far. Identifiers and addresses need a
secret; random strings need an identifier or an address. Scopes are intervals between the starts of blank lines; parts are joined
with the interval they lie in, reduced to which roles it holds (no pairs are made, whatever the number of parts in a scope).

Positions come from the lengths of the matches and of the gaps between them, summed in blocks inside the row.

Defined cases. NULL text is empty: no span. Every row is scanned; rows equal in id and text have the same spans. An
empty table gives an empty result. Extra columns are carried by ``redact`` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantscope.llm.common import null_safe, other_columns, stored, with_text

# The base patterns. A run that is too short fails as a whole, so the least length of the last two can
# stand in the pattern; for assignments it is checked on group 2, as a failing match still takes its place.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts: login identifiers, service addresses, random strings (these mix both cases and digits).
IDENTIFIER = r"""(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
ENDPOINT = r"""(?:https?|ftp|sftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>|]{4,}"""
RANDOM = r"[A-Za-z0-9+/_-]{20,}={0,2}"
BLANK_LINE = r"\n[\x20\t\r]*\n"
#: Kinds in the order of the reports; base kinds first.
KINDS = ("assign", "access", "hex", "identifier", "endpoint", "random")
BASE = 3
#: What each kind is in a credential, and the parts that complement it.
ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}
BLOCK = 128
SPAN = "array<struct<start: bigint, rank: int, end: bigint>>"


def running_sums(values: str) -> Column:
    """Inclusive running sums of an array of longs, by blocks (the work grows little faster than the array)."""
    n = f"size({values})"
    total = "aggregate({}, 0L, (s, x) -> s + x)"
    sums = f"transform(sequence(0, ({n} - 1) div {BLOCK}), b -> {total.format(f'slice({values}, cast(b * {BLOCK} + 1 as int), {BLOCK})')})"
    before = f"transform({sums}, (x, b) -> {total.format(f'slice({sums}, 1, b)')})"
    # `before` is bound once, as the only element of an array, and not computed for every position.
    return F.expr(f"""case when {n} = 0 then array() else flatten(transform(array({before}), before -> transform({values}, (x, i) ->
        before[cast(i div {BLOCK} as int)] + {total.format(f"slice({values}, cast(i - i % {BLOCK} + 1 as int), i % {BLOCK} + 1)")}))) end""")


def with_spans(df: DataFrame, name: str, pattern: str, rank: int, checked: Column | None = None) -> DataFrame:
    """Adds the array ``name`` of the spans (start, rank, end) of ``pattern`` in the column ``text``, ends exclusive.

    ``checked``: an array of booleans, whether each match counts; it may refer to ``m_<name>``, the matched strings.
    """
    found = F.col("text").rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumns({f"m_{name}": F.when(found, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
                         f"g_{name}": F.when(found, F.split("text", pattern, -1)).otherwise(none)})
    df = df.withColumns({f"ok_{name}": checked if checked is not None else F.transform(f"m_{name}", lambda m: F.lit(True)),
                         f"len_{name}": F.transform(f"m_{name}", lambda m: F.length(m).cast("long")),
                         f"step_{name}": F.expr(f"transform(m_{name}, (m, i) -> cast(length(m) + length(g_{name}[i]) as bigint))")})
    df = df.withColumn(f"end_{name}", running_sums(f"step_{name}"))
    spans = F.expr(f"""transform(filter(arrays_zip(end_{name}, len_{name}, ok_{name}), z -> z.ok_{name}), z -> named_struct(
        'start', z.end_{name} - z.len_{name}, 'rank', {rank}, 'end', z.end_{name}))""")
    return df.withColumn(name, spans.cast(SPAN)).drop(*(f"{p}_{name}" for p in ("m", "g", "ok", "len", "step", "end")))


def find_parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash) with an array of spans for each kind, and the starts of blank lines where there are weak parts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    long_enough = F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_CHARS)
    mixed = F.transform("m_random", lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"))
    checks = {"assign": F.when(F.size("m_assign") > 0, long_enough).otherwise(F.array().cast("array<boolean>")), "random": mixed}
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, IDENTIFIER, ENDPOINT, RANDOM)))
    for rank, kind in enumerate(KINDS):
        df = with_spans(df, kind, patterns[kind], rank, checks.get(kind))
    weak = F.size("identifier") + F.size("endpoint") + F.size("random") > 0
    df = with_spans(df.withColumns({"whole": F.col("text"), "text": F.when(weak, F.col("text")).otherwise("")}), "blank", BLANK_LINE, -1)
    return df.select("doc_id", "text_hash", F.concat(*KINDS[:BASE]).alias("base"), F.concat(*KINDS[BASE:]).alias("weak"), "blank")


def linked_parts(parts: DataFrame) -> DataFrame:
    """Per document the weak spans that a complementary part of their scope confirms (``linked``)."""
    key = ["doc_id", "text_hash"]
    some = parts.where((F.size("weak") > 0) & (F.size("base") + F.size("weak") > 1))
    rows = some.select(*key, F.explode(F.concat("base", "weak", "blank")).alias("p")).distinct().select(*key, "p.*")
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("rank") + 1)
    scope = F.sum((F.col("rank") < 0).cast("int")).over(Window.partitionBy(*key).orderBy("start", "rank"))
    rows = rows.withColumn("scope", scope).where("rank >= 0").withColumn("role", role)
    secret = F.col("role") == "secret"
    scopes = rows.groupBy(*(F.col(c).alias(f"o_{c}") for c in [*key, "scope"])).agg(
        F.bool_or(secret).alias("has_secret"), F.bool_or(~secret).alias("has_other"))
    weak = rows.where(F.col("rank") >= BASE)
    linked = weak.join(scopes, null_safe(weak, scopes, [(c, f"o_{c}") for c in [*key, "scope"]]))
    linked = linked.where(F.when(secret, F.col("has_other")).otherwise(F.col("has_secret")))
    return linked.groupBy(*key).agg(F.collect_set(F.struct("start", "rank", "end")).alias("linked"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans): the base spans and all spans of each document, by start, then kind."""
    parts = stored(find_parts(docs), "secret-parts")
    linked = linked_parts(parts).withColumnsRenamed({"doc_id": "l_id", "text_hash": "l_hash"})
    out = parts.join(linked, null_safe(parts, linked, [("doc_id", "l_id"), ("text_hash", "l_hash")]), "left")
    every = F.concat("base", F.coalesce(F.col("linked").cast(SPAN), F.array().cast(SPAN)))
    return out.select("doc_id", "text_hash", F.array_sort("base").alias("base"), F.array_sort(every).alias("spans"))


def described(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(array({names})[s.rank], ':', s.start, ':', s.end)), ',')")


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by one)."""
    found = find_secrets(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
    found = found.select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("r_id"), F.xxhash64(text).alias("r_hash"), F.col("text").alias("clean"),
                       other_columns(docs))
    rows = rows.join(found, null_safe(rows, found, [("r_id", "f_id"), ("r_hash", "f_hash")]), "left")
    quoted = mask.replace("\\", "\\\\").replace("'", "\\'")
    masked = F.expr(f"""aggregate(spans, named_struct('at', 0L, 'parts', cast(array() as array<string>)), (a, s) -> named_struct(
        'at', greatest(a.at, s.end),
        'parts', case when s.start >= a.at then concat(a.parts, array(substring(clean, cast(a.at + 1 as int), cast(s.start - a.at as int)), '{quoted}'))
                 else a.parts end),
        a -> concat(array_join(a.parts, ''), substring(clean, cast(a.at + 1 as int))))""")
    rows = rows.withColumn("clean", F.when(F.col("spans").isNotNull(), masked).otherwise(F.col("clean")))
    return rows.select(*with_text(docs, "clean"))
