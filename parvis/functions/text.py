"""Address text: normalising, comparing, and reading addresses out of descriptions.

Patterns carry the flag ``U`` because Java classes are ASCII-only without it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed

SPACE = r"[\s\x1c-\x1f]"

# The shapes of a street, of a Paris zip code and of a district number.
STREET = (
    r"(?iU)(\d+[a-zA-Z]?)[,\s]+((?:"
    + "|".join(fixed.WAY_TYPES)
    + r")\s+[A-Za-zÀ-ÿ\s\-']+)"
)
ZIP = r"(?U)\b(75\d{3})\b"
DISTRICT = r"(?iU)(?:Paris\s+)?(\d{1,2})(?:" + "|".join(fixed.DISTRICT_ENDINGS) + r")\s*(?:arrondissement)?"


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, no-break spaces included."""
    return F.regexp_replace(F.regexp_replace(text, rf"(?U)^{SPACE}+", ""), rf"(?U){SPACE}+$", "")


def normalize_address(raw: Column) -> Column:
    """Lower-case address with expanded abbreviations and single spaces; '' when missing."""
    text = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), f"[{fixed.IGNORED_PUNCTUATION}]", " ")
    text = reduce(
        lambda t, pair: F.regexp_replace(t, rf"(?iU)\b{pair[0]}\b", pair[1]),
        fixed.STREET_ABBREVIATIONS,
        text,
    )
    return strip(F.regexp_replace(text, rf"(?U){SPACE}+", " "))


def address_similarity(a: Column, b: Column) -> Column:
    """One minus edit distance over the longer length; 0 when a side is empty or null."""
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when(F.coalesce(F.length(a), F.lit(0)) == 0, 0.0)
        .when(F.coalesce(F.length(b), F.lit(0)) == 0, 0.0)
        .when(a == b, 1.0)
        .otherwise(1.0 - F.levenshtein(a, b) / longest)
    )


def first_group(text: Column, pattern: str, group: int) -> Column:
    """Group of the first match, or null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def zip_in(text: Column) -> Column:
    return first_group(text, ZIP, 1).try_cast("int")


def district_in(text: Column) -> Column:
    return first_group(text, DISTRICT, 1).try_cast("int")


def arrond_to_zip(district: Column) -> Column:
    """75001 … 75020 for districts 1 … 20, else null."""
    return F.when(district.between(1, 20), district + 75000).cast("int")


def starts_like_paris(zipcode: Column) -> Column:
    return zipcode.cast("string").startswith("75")


def _found(how: tuple[str, float], address: Column, zipcode: Column) -> Column:
    return F.struct(
        address.alias("address"),
        zipcode.cast("int").alias("zipcode"),
        F.lit(how[1]).alias("confidence"),
        F.lit(how[0]).alias("method"),
    )


def address_clues(raw: Column, description: Column) -> dict[str, Column]:
    """What the texts of a listing say: each clue is null when it is absent."""
    text = F.coalesce(description, F.lit(""))
    return {
        "own": strip(raw),
        "own_zip": zip_in(raw),
        "street_number": first_group(text, STREET, 1),
        "street_name": strip(F.regexp_extract(text, STREET, 2)),
        "text_zip": zip_in(text),
        "district": district_in(text),
    }


def choose_address(clues: dict[str, Column], zipcode: Column, answer: Column | None = None) -> Column:
    """The best address the clues allow, as struct(address, zipcode, confidence, method).

    ``answer`` is a struct of the same shape (see ``answers.parse_address_answer``), null
    when there is none; it is used only where the rules find nothing.
    """
    text_zip, district = clues["text_zip"], clues["district"]
    from_text = F.when(text_zip.isNotNull(), text_zip).when(district.isNotNull(), arrond_to_zip(district))
    silent = text_zip.isNull() & district.isNull()
    street_zip = F.when(silent, zipcode).otherwise(from_text)
    area_zip = F.when(silent, F.when(starts_like_paris(zipcode), zipcode)).otherwise(from_text)
    printed = F.coalesce(street_zip.cast("string"), F.lit("None"))
    street = F.concat(clues["street_number"], F.lit(" "), clues["street_name"], F.lit(", Paris "), printed)

    rules = (
        F.when(
            F.length(clues["own"]) >= fixed.SHORTEST_ADDRESS,
            _found(fixed.EXISTING, clues["own"], F.coalesce(clues["own_zip"], zipcode)),
        )
        .when(clues["street_number"].isNotNull(), _found(fixed.FROM_STREET, street, street_zip))
        .when(
            area_zip.isNotNull() & (area_zip != 0),
            _found(fixed.FROM_ZIP, F.concat(F.lit("Paris "), area_zip.cast("string")), area_zip),
        )
    )
    unknown = _found(fixed.NOT_FOUND, F.lit(""), F.lit(None))
    return F.coalesce(rules, unknown) if answer is None else F.coalesce(rules, answer, unknown)


def extract_address(raw: Column, description: Column, zipcode: Column, answer: Column | None = None) -> Column:
    """``choose_address`` straight from the texts."""
    return choose_address(address_clues(raw, description), zipcode, answer)


def address_usable(zipcode: Column, confidence: Column) -> Column:
    return F.coalesce(zipcode.isNotNull() & (confidence >= fixed.USABLE_CONFIDENCE), F.lit(False))


def effective_zip(address_zip: Column, listing_zip: Column, default: int) -> Column:
    """Zip used for the market: the recovered one if it is in the 75 area, else the listing's."""
    own = F.coalesce(listing_zip, F.lit(default))
    best = F.coalesce(F.nullif(address_zip, F.lit(0)), own)
    return F.when(starts_like_paris(best), best).otherwise(own)
