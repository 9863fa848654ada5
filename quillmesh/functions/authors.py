"""Author strings of library catalogues: ``Name, years [Role]``, read piece by piece."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that are no person's.
NO_PERSON = ("anonymous", "unknown", "various")

#: The words of a piece that may be a date: a number, an era, a mark of birth or death, a dash; anything else is "other".
WORDS_OF_DATE = re.compile(
    r"(?P<number>\d{1,4})\??|(?P<era>BCE|B\.\s?C\.?(?:\s?E\.?)?)|(?P<event>[bd])\.\s|(?P<about>ca\.)|(?P<dash>-)|(?P<other>\S)", re.IGNORECASE
)


def years_of(piece: str) -> tuple[int | None, int | None] | None:
    """(birth, death) of a piece that is a date, years before Christ negative; None where it is none.

    Dates are "1820-1899", "1820-", "428? BCE-348? BCE" (the era may be left out behind the dash), "b. 1820", "d. 1899"; "ca."
    may come first, and a question mark behind a number. Years have three digits at least, those before Christ one.
    """
    shape, numbers = "", []
    for word in WORDS_OF_DATE.finditer(piece + " "):
        kind = word.lastgroup
        if kind == "number":
            numbers.append(int(word["number"]))
            shape += "n" if len(word["number"]) > 2 else "s"  # a short number is a year before Christ only
        else:
            shape += {"era": "e", "dash": "-", "about": "c", "event": word.group().lower()[0]}.get(kind, "x")
    shape = shape.removeprefix("c")
    if shape in ("bn", "dn"):
        return (numbers[0], None) if shape == "bn" else (None, numbers[0])
    first, dash, second = shape.partition("-")
    if not dash:
        return None
    if first in ("ne", "se") and second in ("", "n", "s", "ne", "se"):
        return -numbers[0], -numbers[1] if second else None
    if first == "n" and second in ("", "n"):
        return numbers[0], numbers[1] if second else None
    return None


def author_parts(raw: str | None) -> dict | None:
    """name, birth, death (before Christ negative), role (default "author") and corporate of one author; None for an empty one.

    Corporate: no comma and no years, or a stand-in such as "Various".
    """
    rest = (raw or "").strip()
    role = "author"
    if rest.endswith("]"):
        before, bracket, inner = rest[:-1].rpartition("[")
        if bracket and inner and "]" not in inner:
            rest, role = before.rstrip(), inner.strip().lower()
    name, comma, last = rest.rpartition(",")
    years = years_of(last) if comma else None
    if years is None:
        name = rest
    name = name.strip().strip(",").strip()
    if not name:
        return None
    birth, death = years or (None, None)
    no_person = name.lower() in NO_PERSON or ("," not in name and birth is None and death is None)
    return {"name": name, "birth": birth, "death": death, "role": role, "corporate": int(no_person)}


_PARTS = T.StructType().add("name", "string").add("birth", "integer").add("death", "integer").add("role", "string").add("corporate", "integer")


@F.pandas_udf(_PARTS)
def parsed_author(raw: pd.Series) -> pd.DataFrame:
    """``author_parts`` as a struct; all fields null for an empty string."""
    empty = {"name": None, "birth": None, "death": None, "role": None, "corporate": None}
    out = pd.DataFrame([author_parts(x) or empty for x in raw], columns=list(empty))
    return out.astype({"birth": "Int32", "death": "Int32", "corporate": "Int32"})
