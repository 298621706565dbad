"""Personal data with DataFrame functions only.

Regular expressions propose spans, validators (Luhn, mod 97, ranges) confirm them, and
words near a span adjust its score. Patterns are linear: a possessive run starts only
where the run starts or where the last match ended, which finds the same matches as a
leftmost search without trying every start again.
"""

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """What proposes a span, what confirms it, and how sure it is."""

    name: str
    hint: Callable[[Column], Column]
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _octets(found: Column) -> Column:
    def small(part):
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(found, r"\."), small)


def _card(found: Column) -> Column:
    digits = _digits(found)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _phone(found: Column) -> Column:
    return F.length(_digits(found)).between(9, 15)


def _iban(found: Column) -> Column:
    """The account number turned by four and read as one number leaves 1 when divided by 97."""
    plain = F.regexp_replace(found, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return F.length(plain).between(15, 34) & (rest == 1)


_MAIL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", lambda t: F.contains(t, F.lit("@")),
         rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda f: F.lit(True), 0.9, "e-?mail|contact|write|adresse|correo"),
    Kind("ip", lambda t: t.rlike(r"[0-9]\.[0-9]"),
         r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         _octets, 0.6, r"\bip\b|host|server|address|login"),
    Kind("card", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
         r"[0-9](?:[\x20-]?[0-9])++",
         _card, 0.8, "card|visa|master|credit|karte|tarjeta|carte"),
    Kind("phone", lambda t: F.contains(t, F.lit("+")),
         r"\+[0-9][\x20().0-9-]+[0-9]",
         _phone, 0.7, "phone|call|tel|mobile|fax|whatsapp"),
    Kind("iban", lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
         _iban, 0.8, "iban|account|konto|cuenta|compte", base=False),
    Kind("ssn", lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda f: F.lit(True), 0.4, r"ssn|social|security|tax", base=False),
    Kind("local_phone", lambda t: t.rlike(r"[0-9]{3}[-.\x20][0-9]{3}[-.\x20][0-9]{4}"),
         r"(?<![0-9+.-])\(?[0-9]{3}\)?[-.\x20][0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
         lambda f: F.lit(True), 0.4, "phone|call|tel|mobile|fax|whatsapp", base=False),
)
#: Words that speak against a span, whatever its kind.
AGAINST = r"\b(?:version|order|invoice|isbn|sample|dummy)\b"
NEAR = 40
BONUS = 0.2
KEEP = 0.5
BLOCK = 512

_SPAN = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def _upto(lengths: Column) -> Column:
    """Running sums of an array, the first element excluded from its own; by blocks, so that
    a text of very many matches does not copy its whole list once per match."""
    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), n - 1).cast("int"), F.lit(BLOCK)),
                         lambda i: F.slice(lengths, i + 1, BLOCK))

    def running(values, start):
        return F.aggregate(
            values, F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("all")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"),
                                    F.array_append(acc["all"], acc["at"]).alias("all")))["all"]

    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, running(sums, F.lit(0)), running))


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in a text, as structs; start and end count code points."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    gaps = F.split(text, kind.pattern, -1)
    both = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(
        F.substring(g, -NEAR, NEAR).alias("before"), F.length(g).alias("gap"), f.alias("found"),
        F.length(f).alias("size")))
    starts = _upto(F.transform(both, lambda b: b["gap"] + b["size"]))
    after = F.transform(F.slice(gaps, 2, F.size(found)), lambda g: F.substring(g, 1, NEAR))
    rows = F.arrays_zip(both.alias("match"), starts.alias("at"), after.alias("after"))

    def span(row):
        near = F.lower(F.concat_ws(" ", row["match"]["before"], row["after"]))
        score = (F.lit(kind.score) + F.when(near.rlike(kind.context), BONUS).otherwise(0.0)
                 - F.when(near.rlike(AGAINST), BONUS).otherwise(0.0))
        start = row["at"] + row["match"]["gap"]
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"),
                        (start + row["match"]["size"]).alias("end"), score.alias("score"),
                        F.lit(kind.base).alias("base"))

    confirmed = F.filter(rows, lambda row: kind.valid(row["match"]["found"]))
    spans = F.transform(confirmed, span)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= KEEP)
    return F.when(kind.hint(text), spans).otherwise(F.array()).cast(_SPAN)


def find_spans(docs: DataFrame, text: str = "text") -> Column:
    """All spans of a text, kinds in the order of KINDS, by start within a kind.

    Base kinds keep every confirmed match; the other kinds need a score of at least KEEP,
    which context words raise or lower. A null text is empty and has no spans.
    """
    body = F.coalesce(F.col(text) if text in docs.columns else F.expr(text), F.lit(""))
    return F.concat(*[_spans(body, kind) for kind in KINDS])


def of_kind(kind: str):
    """A filter for the spans of one kind."""
    return lambda span: span["kind"] == kind


def digest_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All documents with personal data replaced by its kind in capitals and angle brackets.

    Spans that overlap become one, named after the first. Other columns stay; a null text
    stays null.
    """
    spans = F.array_sort(F.transform(find_spans(docs, text), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = docs.select(F.struct("*").alias("row"), spans.alias("spans"))
    body = F.col(f"row.`{text}`")
    # Each step adds the text since the last span and the span's name; overlaps add nothing.
    pieces = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"]).alias("upto"),
            F.when(s["start"] >= acc["upto"], F.array_append(acc["out"], F.concat(
                F.substr(body, acc["upto"] + 1, s["start"] - acc["upto"]),
                F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
            .otherwise(acc["out"]).alias("out")))
    rows = rows.withColumn("pieces", F.when(F.size("spans") > 0, pieces))
    clean = F.when(F.size("spans") > 0, F.concat(
        F.array_join("pieces.out", ""), F.substr(body, F.col("pieces.upto") + 1))).otherwise(body)
    return rows.select([clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
