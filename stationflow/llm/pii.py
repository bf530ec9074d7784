"""Personal data: patterns propose spans, check digits confirm them, context adjusts the score.

All of it is DataFrame functions. The places of the matches follow from the lengths
of the matches and of what lies between them. Patterns cannot backtrack over what
they have taken and start where a run starts, or where the last match ended, so that
a long run is not tried again from each of its characters; the matches are those of
the plain patterns beside them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.once import computed_once

# Characters before a match that are looked at for context words.
CONTEXT = 40
# Score that context words add.
BOOST = 0.3
# Added kinds are reported from this score on; base kinds always are.
REPORTED = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    value = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10),
    )
    return F.aggregate(value, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number, upper case and without spaces, has remainder 1."""
    turned = F.split(F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4)), "")
    value = F.transform(turned, lambda c: F.when(F.ascii(c) < 65, F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(
        value, F.lit(0), lambda a, b: F.when(b < 10, (a * 10 + b) % 97).otherwise((a * 100 + b) % 97)
    )
    return rest == 1


# Characters of an account number by its country, as registered.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_length(proposed: Column) -> Column:
    """Characters of the account number that a proposal starts with, null if it has none.

    A number ends where a group of the proposal does. It has the length of its country;
    where the country is not listed, the longest that mod 97 confirms counts.
    """
    groups = F.split(proposed, " ")
    ends = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, 1, n), " "))

    def good(number: Column) -> Column:
        account = F.replace(number, F.lit(" "), F.lit(""))
        country = F.substring(account, 1, 2)
        listed = F.coalesce(*(F.when(country.isin(*names.split()), F.lit(n)) for n, names in _IBAN_LENGTHS.items()), F.length(account))
        fits = F.length(account).between(15, 34) & (F.length(account) == listed)
        return fits & F.rlike(account, F.lit("^[A-Z0-9]+$")) & mod_97(account)

    return F.array_max(F.transform(F.filter(ends, good), F.length))


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``valid`` confirms; ``hint`` is a cheap test a text must pass to have any.

    With ``length``, the pattern takes ``head`` characters and its group 1 has what is
    proposed from their start on; ``length`` is that of the confirmed span, or null. So
    proposals may overlap, and spans that start within the last one are left out.
    """

    name: str
    pattern: str
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str
    length: Callable[[Column], Column] | None = None
    head: int = 0


BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), 0.7, "mail|Mail|contact|Contact",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")), lambda m: F.rlike(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")), 0.5,
        "IP|ip|host|Host|server|address",
    ),
    # [0-9]([\x20-]?[0-9])+
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: F.rlike(t, F.lit(r"[0-9][\x20-]?[0-9]")),
        lambda m: (F.length(m) >= 13) & F.length(_digits(m)).between(13, 19) & luhn(_digits(m)), 0.6,
        "card|Card|visa|Visa|credit|payment",
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")), lambda m: F.length(_digits(m)).between(9, 15), 0.5,
        "phone|Phone|tel|Tel|call|Call|mobile|fax",
    ),
)
ADDED = (
    Kind(
        "iban",
        # The last character, if any, goes on after 34 or is a small letter: no number ends before it.
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}[A-Za-z0-9]?))[A-Z]{2}[0-9]{2}",
        lambda t: F.rlike(t, F.lit(r"[A-Z]{2}[0-9]{2}")), lambda m: F.lit(True),
        0.7, "IBAN|iban|account|Account|bank|Bank", iban_length, 4,
    ),
    Kind(
        "ssn",
        r"[0-9]+(?:-[0-9]+)++",
        lambda t: F.rlike(t, F.lit(r"[0-9]-[0-9]")),
        lambda m: F.rlike(m, F.lit(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")), 0.3,
        "SSN|ssn|Social Security|social security|Tax ID|tax id",
    ),
)
SECRETS = (
    # Keys that tell by their first letters what they are of.
    Kind(
        "key",
        r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}",
        lambda t: F.rlike(t, F.lit("AKIA|gh[pousr]_|xox[abprs]-|sk-")), lambda m: F.lit(True), 0.7, "key|Key|token|Token|secret",
    ),
    # [A-Za-z0-9]{24,} with letters and digits, and a word that says what it is
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])[A-Za-z0-9]{24,}+",
        lambda t: F.rlike(t, F.lit("token|Token|TOKEN|secret|Secret|SECRET|key|Key|KEY|assword|credential")),
        lambda m: F.rlike(m, F.lit("[0-9]")) & F.rlike(m, F.lit("[A-Za-z]")), 0.3,
        "token|Token|TOKEN|secret|Secret|SECRET|key|Key|KEY|assword|credential",
    ),
)
KINDS = BASE + ADDED + SECRETS
_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


# Items that are gone through before what they found is put aside.
_BLOCK = 64


def _gone_through(items: Column, zero: Column, step: Callable[[Column, Column], Column], empty: Column) -> Column:
    """What ``step`` collects in ``found`` over all items; ``zero`` and ``step`` make its state.

    An array that grows by one is copied each time, so a text with very many matches
    is gone through in blocks: each block's finds are an array of their own, put
    beside those of the blocks before.
    """
    start = F.struct(zero.alias("now"), F.filter(F.array(empty), lambda x: x.isNull()).alias("done"))

    def over(items: Column) -> Column:
        def block(seen: Column, i: Column) -> Column:
            begins = seen["now"].withField("found", empty)
            return F.struct(
                F.aggregate(F.slice(items, i * _BLOCK + 1, _BLOCK), begins, step).alias("now"),
                F.array_append(seen["done"], seen["now"]["found"]).alias("done"),
            )

        blocks = F.sequence(F.lit(0), ((F.size(items) - 1) / _BLOCK).cast("int"))
        return F.aggregate(blocks, start, block, lambda s: F.flatten(F.array_append(s["done"], s["now"]["found"])))

    # Inside a lambda the items are a value; as an expression they would be made again for each block.
    return F.transform(F.array(items), over)[0]


def kind_spans(text: Column, kind: Kind, whole_context: bool = True) -> Column:
    """``kind, start, end, score`` of the confirmed matches of a text, by start.

    Places are code points, the end is exclusive. A match that is not confirmed is
    dropped whole. Context words are looked for in the ``CONTEXT`` characters before a
    match; without ``whole_context``, no further back than the last proposal of the kind.
    """
    group = F.lit(1 if kind.length else 0)
    found = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(kind.pattern), group).alias("match"))
    base = kind in BASE
    last = lambda *parts: F.right(F.concat(*parts), F.lit(CONTEXT))

    def step(seen: Column, x: Column) -> Column:
        gap = F.right(x["gap"], F.lit(CONTEXT))
        near = F.rlike(last(seen["before"], gap) if whole_context else gap, F.lit(kind.words))
        start = seen["at"] + F.length(x["gap"])
        taken = F.lit(kind.head) if kind.length else F.length(x["match"])
        end = start + (kind.length(x["match"]) if kind.length else taken)
        score = F.when(near, kind.score + BOOST).otherwise(kind.score)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        good = x["match"].isNotNull() & kind.valid(x["match"])
        if kind.length:
            good = good & (start >= seen["free"]) & end.isNotNull()
        if not base and kind.score < REPORTED:
            good = good & near
        spans = F.when(good, F.array_append(seen["found"], span)).otherwise(seen["found"])
        through = F.substring(x["match"], 1, kind.head) if kind.length else F.right(x["match"], F.lit(CONTEXT))
        before = last(seen["before"], gap, through) if whole_context else seen["before"]
        free = F.when(good, end).otherwise(seen["free"]) if kind.length else seen["free"]
        return F.struct((start + taken).alias("at"), before.alias("before"), free.alias("free"), spans.alias("found"))

    none = F.array().cast(_SPANS)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.lit(0).alias("free"), none.alias("found"))
    return F.when(kind.hint(text), _gone_through(found, zero, step, none)).otherwise(none)


def all_spans(text: Column, kinds: tuple[Kind, ...] = KINDS, whole_context: bool = True) -> Column:
    """The spans of all kinds; a null text has none."""
    content = F.coalesce(text, F.lit(""))
    return F.concat(*(kind_spans(content, k, whole_context) for k in kinds))


def find_pii(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", kinds: tuple[Kind, ...] = KINDS,
    whole_context: bool = True,
) -> DataFrame:
    """``keep`` and ``findings``: all spans, by kind in the order of ``kinds``, then start.

    A null or empty text has none; the time a text takes grows with its length and its
    matches. Null ids and repeated rows are rows as any other, no rows give none, and
    columns that are not in ``keep`` are left out. ``whole_context`` as in ``kind_spans``.
    """
    return computed_once(docs, keep, "findings", all_spans(F.col(text), kinds, whole_context))


# Characters of a text that are cut off at a time when it is put together anew.
_CHUNK = 2048


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` to before ``end`` of a text in chunks, without going through all before."""
    a, b = (start / _CHUNK).cast("int"), (end / _CHUNK).cast("int")
    piece = lambda i: F.coalesce(F.try_element_at(chunks, i + 1), F.lit(""))
    within = F.substring(piece(a), start % _CHUNK + 1, end - start)
    across = F.concat(
        F.substring(piece(a), start % _CHUNK + 1, F.lit(_CHUNK)), F.array_join(F.slice(chunks, a + 2, b - a - 1), ""), F.substring(piece(b), F.lit(1), end % _CHUNK)
    )
    return F.when(end <= start, F.lit("")).when(a == b, within).otherwise(across)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind, as ``<EMAIL>``.

    Of spans that overlap, the one that starts first names the whole stretch. A null
    text stays null; ``n_chars``, where there is one, is counted anew. Other columns
    stay as they are, whatever their names.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = names[text]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    found = computed_once(plain, list(names.values()), "spans", all_spans(F.col(own)))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(seen: Column, s: Column) -> Column:
        new = F.struct(seen["at"].alias("from"), s["start"].alias("to"), s["kind"].alias("kind"))
        return F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(s["start"] >= seen["at"], F.array_append(seen["found"], new)).otherwise(seen["found"]).alias("found"),
        )

    none = F.array().cast("array<struct<from:int,to:int,kind:string>>")
    parts = computed_once(found, list(names.values()), "cuts", F.struct(
        _gone_through(order, F.struct(F.lit(0).alias("at"), none.alias("found")), step, none).alias("kept"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["end"])), F.lit(0)).alias("last"),
        F.regexp_extract_all(own, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)).alias("chunks"),
        F.length(own).alias("size"),
    ))
    told = F.transform("cuts.kept", lambda c: F.concat(_cut(F.col("cuts.chunks"), c["from"], c["to"]), F.lit("<"), F.upper(c["kind"]), F.lit(">")))
    done = F.concat(F.array_join(told, ""), _cut(F.col("cuts.chunks"), F.col("cuts.last"), F.col("cuts.size")))
    clean = F.when(F.size("cuts.kept") > 0, done).otherwise(F.col(own))
    out = computed_once(parts, [n for n in names.values() if n != own], own, clean)
    return out.select(*(
        (F.length(own).cast(docs.schema[c].dataType) if c == "n_chars" else F.col(n)).alias(c) for c, n in names.items()
    ))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{folder}/documents.parquet"))
    of = lambda *names: F.filter("findings", lambda s: s["kind"].isin(*names))
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = [k.name for k in BASE]
    return found.select(
        "doc_id",
        *(F.size(of(name)).cast("long").alias(f"n_{name}") for name in base),
        F.sha2(told(of(*base)), 256).alias("base_sha256"),
        told(F.col("findings")).alias("spans"),
    )


OP2_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
z AS (
  SELECT k, 1 AS o, 'email' AS kind, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS m, regexp_split_to_array(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS g FROM t
  UNION ALL SELECT k, 2, 'ip', regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), regexp_split_to_array(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') FROM t
  UNION ALL SELECT k, 3, 'card', regexp_extract_all(text, '[0-9]([\x20-]?[0-9])+'), regexp_split_to_array(text, '[0-9]([\x20-]?[0-9])+') FROM t
  UNION ALL SELECT k, 4, 'phone', regexp_extract_all(text, '\+[0-9][\x20().0-9-]+[0-9]'), regexp_split_to_array(text, '\+[0-9][\x20().0-9-]+[0-9]') FROM t
  UNION ALL SELECT k, 5, 'iban', regexp_extract_all(text, '[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}'), regexp_split_to_array(text, '[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}') FROM t
  UNION ALL SELECT k, 6, 'ssn', regexp_extract_all(text, '[0-9]+(?:-[0-9]+)+'), regexp_split_to_array(text, '[0-9]+(?:-[0-9]+)+') FROM t
  UNION ALL SELECT k, 7, 'key', regexp_extract_all(text, '(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,})'), regexp_split_to_array(text, '(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,})') FROM t
  UNION ALL SELECT k, 8, 'secret', regexp_extract_all(text, '[A-Za-z0-9]{24,}'), regexp_split_to_array(text, '[A-Za-z0-9]{24,}') FROM t),
u AS (SELECT k, o, kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS s, unnest(g[1:len(m)]) AS gap FROM z WHERE len(m) > 0),
p AS (
  SELECT *, regexp_replace(s, '[^0-9]', '', 'g') AS d, replace(s, ' ', '') AS c,
    CAST(sum(length(gap) + length(s)) OVER (PARTITION BY k, o ORDER BY i) AS BIGINT) AS stop FROM u),
q AS (SELECT p.*, substr(text, greatest(stop - length(s) - 40, 0) + 1, least(stop - length(s), 40)) AS near FROM p JOIN t USING (k)),
v AS (
  SELECT * FROM q WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'key' THEN true
    WHEN 'secret' THEN regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]')
      AND regexp_matches(near, 'token|Token|TOKEN|secret|Secret|SECRET|key|Key|KEY|assword|credential')
    WHEN 'ip' THEN len(list_filter(string_split(s, '.'), lambda x: TRY_CAST(x AS HUGEINT) <= 255)) = 4
    WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda j:
      CASE WHEN (length(d) - j) % 2 = 0 THEN CAST(substr(d, j, 1) AS INT)
      ELSE (2 * CAST(substr(d, j, 1) AS INT)) // 10 + (2 * CAST(substr(d, j, 1) AS INT)) % 10 END)) % 10 = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(c) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(range(1, length(c) + 1), lambda j:
      CASE WHEN ascii(substr(substr(c, 5) || substr(c, 1, 4), j, 1)) < 65 THEN ascii(substr(substr(c, 5) || substr(c, 1, 4), j, 1)) - 48
      ELSE ascii(substr(substr(c, 5) || substr(c, 1, 4), j, 1)) - 55 END)), lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97) = 1
    ELSE regexp_full_match(s, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND NOT regexp_matches(s, '^(000|666|9)|^....00|0000$')
      AND regexp_matches(near, 'SSN|ssn|Social Security|social security|Tax ID|tax id') END),
a AS (
  SELECT k, count(*) FILTER (o = 1) AS e, count(*) FILTER (o = 2) AS ip, count(*) FILTER (o = 3) AS c, count(*) FILTER (o = 4) AS ph,
    string_agg(concat(kind, ':', stop - length(s), ':', stop), ',' ORDER BY o, i) FILTER (o < 5) AS base,
    string_agg(concat(kind, ':', stop - length(s), ':', stop), ',' ORDER BY o, i) AS spans
  FROM v GROUP BY k)
SELECT doc_id, coalesce(e, 0) AS n_email, coalesce(ip, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(ph, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (k)
"""
