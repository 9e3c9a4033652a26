"""Personal data in text: patterns propose, checksums confirm, nearby words adjust the score.

Each kind has a pattern. Its matches are leftmost and do not overlap; a match that its
validator rejects is dropped, without another try inside it. Kinds are sought apart from each
other, so spans of different kinds may overlap.

A span's score is that of its kind's pattern, plus a part for a checksum that holds (Luhn for
cards, mod-97 for account numbers), plus a part for a word about the kind within `NEAR`
characters on either side, as far as the neighbouring matches of the kind. Spans of base kinds are always reported; those of further kinds
(account numbers, phone numbers without country code, social security numbers) if their score
reaches `ACCEPT`: an account number by its checksum, the other two by the words around them.

Everything is a column expression on the text: one pass over the rows, no shuffle, no Python,
whatever the number of spans. Positions need the lengths of all text before a span: the text
between matches and the matches alternate, and their lengths are summed up in blocks.

Patterns never scan a run of characters again from each place in it, so texts of any length
take time in proportion: a mail address starts at the beginning of a run or right behind the
last match, and repetitions give nothing back.

A null text counts as empty. Repeated rows, null ids and texts without spans each give their
row, with an empty list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters on either side in which words count; the score (in hundredths) that reports a span.
NEAR, ACCEPT = 48, 60
# Lengths that are summed up at a time.
BLOCK = 64


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. Scores are hundredths; `valid` sees (match, before, after)."""

    name: str
    pattern: str
    words: str
    pattern_score: int
    context_score: int
    valid: Callable[[Column, Column, Column], Column]
    checksum_score: int = 0
    base: bool = True
    needs: str = "0123456789"  # a text without any of these characters has no match


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it, by sums of blocks."""

    def by_blocks(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.call_function("div", F.size(values) - 1, F.lit(BLOCK)).cast("int"))

        def block(b: Column) -> Column:
            return F.slice(values, b * BLOCK + 1, F.lit(BLOCK))

        def with_sums(sums: Column) -> Column:
            def one(b: Column) -> Column:
                return let(
                    F.struct(total(F.slice(sums, F.lit(1), b)).alias("base"), block(b).alias("part")),
                    lambda s: F.transform(s["part"], lambda _, i: s["base"] + total(F.slice(s["part"], F.lit(1), i))),
                )

            return F.flatten(F.transform(numbers, one))

        return let(F.transform(numbers, lambda b: total(block(b))), with_sums)

    return let(lengths, by_blocks)


# -- validators -------------------------------------------------------------------------


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def any_match(match: Column, before: Column, after: Column) -> Column:
    return F.lit(True)


def ip_parts(match: Column, before: Column, after: Column) -> Column:
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def card_number(match: Column, before: Column, after: Column) -> Column:
    return let(digits(match), lambda d: F.length(d).between(14, 19) & F.call_function("luhn_check", d))


def phone_digits(match: Column, before: Column, after: Column) -> Column:
    return F.length(digits(match)).between(10, 15)


def account_number(match: Column, before: Column, after: Column) -> Column:
    """Stands alone, and mod 97 leaves 1 with the first four characters put last and letters
    read as 10 to 35."""

    def remainder(text: Column) -> Column:
        def step(left: Column, i: Column) -> Column:
            code = F.ascii(F.substring(text, i, F.lit(1)))
            return F.when(code < 65, left * 10 + code - 48).otherwise(left * 100 + code - 55) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)

    turned = let(F.translate(match, " ", ""), lambda m: F.concat(F.substring(m, 5, 34), F.substring(m, 1, 4)))
    alone = ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
    return alone & (let(turned, remainder) == 1)


def alone(match: Column, before: Column, after: Column) -> Column:
    """Digits that are not a piece of a longer number or word."""
    return (
        ~match.startswith("+")
        & ~before.rlike(r"[A-Za-z0-9.+-]$|[0-9][\x20]$")
        & ~after.rlike(r"^[A-Za-z0-9]|^[\x20.-][0-9]")
    )


# The patterns of the base kinds, words as people write them near such data.
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "mail|email|contact|write|correo|courriel|kontakt",
        60,
        30,
        any_match,
        needs="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "ip|host|server|address|login|serveur|adresse",
        60,
        30,
        ip_parts,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?+[0-9])++",
        "card|visa|mastercard|credit|debit|payment|carte|karte|tarjeta",
        30,
        20,
        card_number,
        checksum_score=50,
    ),
    Kind("phone", PHONE, "tel|phone|call|fax|mobile|telefon|telefono", 60, 30, phone_digits, needs="+"),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
        "iban|account|bank|konto|compte|cuenta|transfer",
        20,
        20,
        account_number,
        checksum_score=60,
        base=False,
    ),
    # a number with country code is matched first, and then is no number without one
    Kind(
        "tel",
        PHONE + r"|[0-9]{2,4}[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}",
        "tel|phone|call|fax|mobile|telefon|telefono",
        30,
        40,
        alone,
        base=False,
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "ssn|social|security|taxpayer",
        30,
        40,
        alone,
        base=False,
    ),
)

SPAN = "start long, rank int, kind string, stop long, score int"


def spans_of_kind(text: Column, rank: int, kind: Kind) -> Column:
    """The kind's accepted spans in the order of the text."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match"),
        F.split(text, kind.pattern, -1).alias("gap"),
    )
    near = rf"(?i)(?:^|[^a-z])(?:{kind.words})(?:[^a-z]|$)"

    def measured(s: Column) -> Column:
        lengths = F.transform(s["match"], lambda m, i: (F.length(m) + F.length(s["gap"][i])).cast("long"))

        def span(before_all: Column, i: Column) -> Column:
            match = F.get(s["match"], i)
            before = F.concat(F.right(F.coalesce(F.get(s["match"], i - 1), F.lit("")), F.lit(NEAR)), F.right(s["gap"][i], F.lit(NEAR)))
            after = F.concat(F.left(s["gap"][i + 1], F.lit(NEAR)), F.left(F.coalesce(F.get(s["match"], i + 1), F.lit("")), F.lit(NEAR)))

            def scored(c: Column) -> Column:
                start = before_all + F.length(s["gap"][i])
                score = F.lit(kind.pattern_score + kind.checksum_score) + F.when(
                    c["before"].rlike(near) | c["after"].rlike(near), kind.context_score
                ).otherwise(0)
                return F.when(
                    kind.valid(c["match"], c["before"], c["after"]),
                    F.struct(
                        start.alias("start"),
                        F.lit(rank).alias("rank"),
                        F.lit(kind.name).alias("kind"),
                        (start + F.length(c["match"])).alias("stop"),
                        score.alias("score"),
                    ),
                )

            context = F.struct(
                match.alias("match"),
                F.right(before, F.lit(NEAR)).alias("before"),
                F.left(after, F.lit(NEAR)).alias("after"),
            )
            return let(context, scored)

        return F.transform(sums_before(lengths), span)

    least = 0 if kind.base else ACCEPT
    kept = F.filter(let(found, measured), lambda c: c.isNotNull() & (c["score"] >= least))
    none = F.array().cast(f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")
    possible = text.contains(kind.needs) if len(kind.needs) == 1 else text.rlike(f"[{kind.needs}]")
    return F.when(possible, kept).otherwise(none)


def find_spans(text: Column) -> Column:
    """All spans of a text by start and kind: array of (start, rank, kind, stop, score). Positions
    count code points from 0; stop is exclusive."""
    return let(
        F.coalesce(text, F.lit("")),
        lambda t: F.array_sort(F.flatten(F.array(*(spans_of_kind(t, rank, kind) for rank, kind in enumerate(KINDS))))),
    )


def personal_data(df: DataFrame, text_col: str, out_col: str = "pii") -> DataFrame:
    """The rows of `df` with their spans in `out_col`."""
    return df.withColumn(out_col, find_spans(df[text_col]))


def is_base(span: Column) -> Column:
    return span["rank"] < sum(k.base for k in KINDS)


def listed(spans: Column) -> Column:
    """`kind:start:stop`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
