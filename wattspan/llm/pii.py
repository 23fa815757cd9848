"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Spark SQL functions only, one row in and one row out, no shuffle. Patterns use possessive groups and
anchored starts, so a very long run of letters or digits is read once. Offsets are code points, ends
are exclusive.

Defined results: NULL text counts as empty; a text without spans gets an empty list; repeated rows and
ids are scored row by row; other columns pass through `redact`, whatever their names; `find` replaces a
column of the name it is given; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_starts, unused, whole_text

#: Kinds in output order; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "tel")

#: Proposal patterns. A start is taken after a non-member or right after a match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "tel": r"(?<![0-9+(-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2,3}(?![0-9-])",
}

#: Words that speak for a kind when they stand near a span.
CONTEXT = {
    "email": "mail|contact|write|schreib|correo|courriel",
    "ip": "addr|host|server|ip|login",
    "card": "card|visa|amex|credit|karte|carte|tarjeta|payment",
    "phone": "tel|phone|call|mobile|fax|anruf|appel",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance",
    "tel": "tel|phone|call|mobile|fax|anruf|appel",
}

#: Score of a confirmed span without context, and what a context word adds.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "tel": 0.4}
CONTEXT_BONUS = 0.2
THRESHOLD = 0.55
WINDOW = 40

_MARK = "\u0001"
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string,score:double>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True when a digit string passes the Luhn checksum."""
    def total(figures: Column) -> Column:
        return F.aggregate(
            F.transform(figures, lambda d, i: let(
                d.cast("int") * F.when((F.size(figures) - i) % 2 == 0, 2).otherwise(1),
                lambda v: F.when(v > 9, v - 9).otherwise(v),
            )),
            F.lit(0), lambda a, v: a + v,
        )

    return let(F.array_remove(F.split(number, ""), ""), lambda f: total(f)) % 10 == 0


def mod97(account: Column) -> Column:
    """True when an IBAN without blanks leaves 1 on division by 97."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.array_remove(F.split(turned, ""), ""), F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    count = F.length(digits(value))
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda p: let(F.ltrim(p, F.lit("0")),
                          lambda q: (F.length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255)),
        )
    if kind == "card":
        return F.when((count >= 16) & (count <= 19), luhn(digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (count >= 8) & (count <= 15)
    if kind == "iban":
        return mod97(F.replace(value, F.lit(" "), F.lit("")))
    if kind == "ssn":
        area = F.substring(value, 1, 3)
        return ~(area.isin("000", "666") | area.startswith("9") | value.contains("-00-") | value.endswith("-0000"))
    if kind == "tel":
        return (count >= 7) & (count <= 12)
    return F.lit(True)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match of the kind passes."""
    if kind == "email":
        return text.contains("@")
    if kind == "phone":
        return text.contains("+")
    return text.rlike("[0-9]")


def _spans(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind: the text is cut at its matches, so odd pieces are matches."""
    clean = F.translate(text, _MARK, "\u0002")
    pieces = F.split(F.regexp_replace(clean, PATTERNS[kind], f"{_MARK}$0{_MARK}"), _MARK)

    def cut(parts: Column) -> Column:
        def found(starts: Column) -> Column:
            def span(value: Column, i: Column) -> Column:
                near = F.lower(F.concat(
                    F.substring(F.get(parts, i - 1), -WINDOW, WINDOW), F.lit(" "),
                    F.substring(F.get(parts, i + 1), 1, WINDOW),
                ))
                score = F.lit(PRIOR[kind]) + F.when(
                    near.rlike(rf"(?<![a-z])(?:{CONTEXT[kind]})"), CONTEXT_BONUS
                ).otherwise(0.0)
                start = F.get(starts, i)
                return F.struct(
                    F.lit(kind).alias("kind"), start.alias("start"),
                    (start + F.length(value)).alias("end"), value.alias("value"), score.alias("score"),
                )

            each = F.transform(parts, lambda v, i: F.when((i % 2 == 1) & _confirmed(kind, v), span(v, i)))
            return F.filter(each, lambda s: s.isNotNull() & (s["score"] >= THRESHOLD))

        return let(running_starts(F.transform(parts, F.length)), found)

    hit = F.when(_possible(kind, text), text.rlike(PATTERNS[kind])).otherwise(F.lit(False))
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(hit, let(pieces, cut)).otherwise(none).cast(f"array<{_SPAN}>")


def find(docs: DataFrame, name: str = "pii") -> DataFrame:
    """Add the confirmed spans, by kind and then by start, under the given name."""
    text = whole_text()
    kinds = [*BASE_KINDS, *ADDED_KINDS]
    return docs.withColumn(name, F.concat(*[_spans(k, text) for k in kinds]))


def joined(spans: Column) -> Column:
    """`kind:start:end`, comma-joined in list order."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def redact(docs: DataFrame) -> DataFrame:
    """Replace every span by its kind in brackets; overlapping spans become one, the earliest kind's.

    NULL texts stay NULL. `n_chars`, where present, is brought up to date.
    """
    text, spans = whole_text(), unused(docs, "pii")
    ordered = F.array_sort(F.transform(
        F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    ))

    def step(done: Column, s: Column) -> Column:
        plain = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.when(s["start"] >= done["at"], F.struct(
            s["end"].alias("at"), F.concat(done["out"], plain, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"),
        )).otherwise(F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out")))

    begun = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        ordered, begun, step,
        lambda d: F.concat(d["out"], F.substring(text, (d["at"] + 1).cast("int"), F.length(text))),
    )
    out = find(docs, spans).withColumn("text", F.when(F.size(spans) > 0, masked).otherwise(F.col("text"))).drop(spans)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def query(docs: DataFrame) -> DataFrame:
    """The registered digest: counts of the base kinds, their hash, all spans, and the highest score."""
    def of(kind: str) -> Column:
        return F.filter("pii", lambda s: s["kind"] == kind)

    found = find(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"),
    )
