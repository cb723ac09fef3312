"""Operator 7, personal data: patterns propose, checksums confirm, context scores.

Built-in functions only. A span's place follows from splitting the text at the
same pattern: the pieces between the matches and the matches themselves, in
turn, have lengths whose running sum gives every start, in code points.

Patterns that repeat a group, as in ``(\\.[a-z]+)+``, would take one stack frame a
repetition on a very long text. The text is therefore prepared, character by
character, so that a plain character class says the same: a full stop that no
name character follows gets another sign, and so does a separator that stands
alone between two digits.

Every kind has a base score; a word such as "card" or "phone" near the span adds
to it. Base kinds (email, ip, card, phone) always stay; the added kinds stay from
``KEEP`` on: iban by its mod-97 checksum, ssn and tel (a number without country
code) only with such words close by.

Defined cases: a null text counts as empty; no spans give empty strings (the
hash of the empty text); kinds may overlap; rows are handled one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, query

# Kinds in the order in which equal starts are listed.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "tel")
SCORE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "tel": 0.3}
WORDS = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|login|adresse",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|ruf|llame|appel",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security",
    "tel": "phone|call|tel|mobile|fax|ruf|llame|appel",
}
BONUS = 0.25
KEEP = 0.5
BEFORE, AFTER = 40, 20

_DOT, _SEP = "\u0002", "\u0003"
_EMAIL = (rf"(?:\G|(?<![A-Za-z0-9._%+{_DOT}-]))[A-Za-z0-9._%+{_DOT}-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++")
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"(?<![0-9{_SEP}])[0-9][0-9{_SEP}]{{11,36}}(?![0-9{_SEP}])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_TEL = r"(?<![0-9+().-])0[0-9]{2,4}[\x20/-][0-9][0-9\x20-]{4,9}[0-9](?![0-9])"

# Running sums are taken over blocks, so that many spans stay affordable.
_BLOCK = 256


def _running(values: Column) -> Column:
    """Inclusive running sums of an array of integers."""

    def plain(xs: Column, start: Column) -> Column:
        return F.aggregate(
            xs, F.struct(start.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"] + x)).alias("all")),
            lambda a: a["all"],
        )

    zero = F.lit(0)
    blocks = F.transform(
        F.sequence(zero, F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    totals = F.transform(blocks, lambda xs: F.aggregate(xs, zero, lambda a, x: a + x))
    starts = F.zip_with(plain(totals, zero), totals, lambda s, t: s - t)
    long_way = F.flatten(F.zip_with(blocks, starts, plain))
    return F.when(F.size(values) <= _BLOCK, plain(values, zero)).otherwise(long_way)


def _spans(text: Column, found: Column, pattern: str) -> Column:
    """``array<struct<start, end, value>>`` of the matches ``found`` of a pattern in a text."""
    before = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length)
    earlier = F.concat(F.array(F.lit(0)), F.transform(F.slice(found, F.lit(1), F.size(found) - 1), F.length))
    starts = _running(F.zip_with(before, earlier, lambda a, b: a + b))
    placed = F.zip_with(starts, found, lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end"), v.alias("value")))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """From the right, every second digit doubled, its digits added: the sum ends in 0."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def _mod97(value: Column) -> Column:
    """IBAN: the first four signs moved to the end, letters as 10..35, remainder 1."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    number = F.transform(F.split(moved, ""), lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(number, F.lit(0), lambda a, d: F.when(d > 9, a * 100 + d).otherwise(a * 10 + d) % 97) == 1


def _octets(value: Column) -> Column:
    """All four parts at most 255, however many zeros lead."""
    return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text, spans``: per row ``array<struct<start, rank, end, kind, score>>`` in order."""
    none = F.array().cast("array<string>")
    docs = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Texts that cannot hold a kind skip its preparation.
    prepared = docs.withColumns({
        "t_email": F.when(
            F.contains("text", F.lit("@")),
            F.regexp_replace(F.translate("text", _DOT, " "), r"\.(?![A-Za-z0-9-])", _DOT)),
        "t_card": F.when(
            F.col("text").rlike("[0-9](?:[ -]?[0-9]){11}"),
            F.regexp_replace(F.translate("text", _SEP, _DOT), "(?<=[0-9])[ -](?=[0-9])", _SEP)),
        "t_phone": F.when(F.contains("text", F.lit("+")), F.col("text")),
    })
    source = {"email": "t_email", "ip": "text", "card": "t_card", "phone": "t_phone", "iban": "text", "ssn": "text", "tel": "text"}
    pattern = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE, "iban": _IBAN, "ssn": _SSN, "tel": _TEL}
    kinds = BASE + ADDED
    proposed = prepared.withColumns({
        f"f_{k}": F.coalesce(F.regexp_extract_all(source[k], F.lit(pattern[k]), F.lit(0)), none) for k in kinds
    })
    placed = proposed.withColumns({f"s_{k}": _spans(F.col(source[k]), F.col(f"f_{k}"), pattern[k]) for k in kinds})
    valid = {
        "email": None, "ssn": None, "tel": None,
        "ip": lambda x: _octets(x["value"]),
        "card": lambda x: F.length(_digits(x["value"])).between(12, 19) & _luhn(_digits(x["value"])),
        "phone": lambda x: F.length(_digits(x["value"])).between(9, 15),
        "iban": lambda x: _mod97(x["value"]),
    }
    confirmed = placed.withColumns({
        f"s_{k}": F.filter(f"s_{k}", check) for k, check in valid.items() if check is not None
    })

    def near(kind: str, x: Column) -> Column:
        """Does a context word stand shortly before or after the span?"""
        lo = F.greatest(x["start"] - BEFORE, F.lit(0))
        around = F.concat_ws(
            " ", F.substring(F.col("text"), lo + 1, x["start"] - lo), F.substring(F.col("text"), x["end"] + 1, F.lit(AFTER)))
        return F.lower(around).rlike(rf"\b(?:{WORDS[kind]})")

    def scored(kind: str) -> Column:
        rank = kinds.index(kind)
        return F.transform(f"s_{kind}", lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"),
            (F.lit(SCORE[kind]) + F.when(near(kind, x), BONUS).otherwise(0.0)).alias("score")))

    listed = F.concat(*(scored(k) for k in kinds))
    lasting = F.filter(listed, lambda x: (x["rank"] < len(BASE)) | (x["score"] >= KEEP))
    return confirmed.select(F.col(id_col), "text", F.array_sort(lasting).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones joined, replaced by its kind in brackets."""

    def step(a: Column, x: Column) -> Column:
        fresh = x["start"] >= a["at"]
        return F.struct(
            F.when(fresh, F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
            .otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], x["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    masked = F.aggregate(
        spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(number(k) for k in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)).alias("max_score"),
    )
