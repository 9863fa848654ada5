"""String expressions. All are built-in expressions that stay inside code generation, unless named otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no identity in a person's name.
HONORIFICS = "sir dame lord lady baron baroness earl duke rev dr prof jr sr saint st mrs mr ms of the".split()
# Sections of the library classification.
CLASS_SECTIONS = "A B C D E F G H J K L M N P Q R S T U V Z".split()


def squeeze(text: Column) -> Column:
    """White space collapsed to single blanks and trimmed; null becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def first_int(text: Column) -> Column:
    """The first run of digits after commas are removed, as bigint; null where there is none."""
    return F.regexp_extract(F.regexp_replace(text, ",", ""), r"(\d+)", 1).try_cast("bigint")


def whole_int(text: Column) -> Column:
    """The whole string as bigint; null where it isn't one."""
    return F.trim(text).try_cast("bigint")


def tri_state(text: Column) -> Column:
    """True, false or null (unknown) of the usual spellings of a flag."""
    low = F.lower(F.trim(text.cast("string")))
    return F.when(low.isin("1", "true", "yes", "y", "t"), True).when(low.isin("0", "false", "no", "n", "f"), False)


def string_list(text: Column) -> Column:
    """A JSON array of strings, or values separated by commas, as an array: lower case, trimmed, each once, in order."""
    parsed = F.from_json(text, "array<string>")
    parts = F.when(F.trim(text).startswith("["), F.coalesce(parsed, F.array().cast("array<string>"))).otherwise(F.split(text, ","))
    clean = F.filter(F.transform(parts, lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return F.coalesce(F.array_distinct(clean), F.array().cast("array<string>"))


def distinct_ignoring_case(items: Column) -> Column:
    """An array without items that differ only by case from an earlier one; order and first spelling stay."""
    step = F.aggregate(
        items,
        F.array().cast("array<string>"),
        lambda kept, x: F.when(F.exists(kept, lambda k: F.lower(k) == F.lower(x)), kept).otherwise(F.concat(kept, F.array(x))),
    )
    return step


def plain_name(text: Column) -> Column:
    """A person's name for comparison: lower case, no brackets, only a-z and commas, no honorifics. Not an identifier."""
    s = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\([^)]*\)", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"[^a-z\s,]", " "), rf"\b(?:{'|'.join(HONORIFICS)})\b", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def surname_and_given(text: Column) -> Column:
    """struct(surname, given) of ``plain_name``: around the comma, or the last word and those before it.

    Over large tables make a column of ``plain_name`` first and use ``parts_of_plain_name``: the name is cleaned once then.
    """
    return parts_of_plain_name(plain_name(text))


def parts_of_plain_name(n: Column) -> Column:
    words = F.split(n, " ")
    by_comma = F.struct(F.trim(F.substring_index(n, ",", 1)).alias("surname"), F.trim(F.regexp_replace(n, r"^[^,]*,", "")).alias("given"))
    by_order = F.struct(F.element_at(words, -1).alias("surname"), F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("given"))
    return F.when(n.contains(","), by_comma).when(F.size(words) > 1, by_order).otherwise(F.struct(n.alias("surname"), F.lit("").alias("given")))


def person_key(name: Column, birth: Column, death: Column) -> Column:
    """Lower-case name without brackets and punctuation, with the years of life where one is known."""
    base = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), r"\s+", " "), r"\([^)]*\)", ""))
    base = F.trim(F.regexp_replace(base, r"[^a-z0-9, ]", ""))
    years = F.concat(F.coalesce(birth.cast("string"), F.lit("")), F.lit("-"), F.coalesce(death.cast("string"), F.lit("")))
    return F.when(F.coalesce(birth, death).isNotNull(), F.concat(base, F.lit("|"), years)).otherwise(base)


def spaced_name(text: Column) -> Column:
    """Dots and dashes as blanks, squeezed, lower case."""
    return F.lower(squeeze(F.regexp_replace(F.coalesce(text, F.lit("")), r"[.\-–—_]", " ")))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def topic_slug(repository: Column) -> Column:
    """The topic that a curated list is named after: its name without "awesome" and "list" at the ends."""
    name = F.lower(F.regexp_replace(repository, r"^[^/]*/", ""))
    s = F.regexp_replace(F.regexp_replace(name, r"^awesome[-_]?", ""), r"[-_]?awesome$", "")
    s = F.regexp_replace(s, r"^lists?[-_]", "")
    return F.when(s != "", s).otherwise(name)


def named_like_a_list(repository: Column) -> Column:
    name = F.lower(F.regexp_replace(repository, r"^[^/]*/", ""))
    return name.contains("awesome") | name.startswith("list-of-")


def owner(full_name: Column) -> Column:
    """What stands before the first slash; null without slash."""
    return F.when(F.instr(full_name, "/") > 0, F.substring_index(full_name, "/", 1))


def split_values(text: Column, separator: str = ";") -> Column:
    """Packed values as an array, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != "")


def facets(heading: Column) -> Column:
    """array<struct(depth, facet)> of a subject heading whose facets are joined by "--"."""
    return F.transform(split_values(heading, "--"), lambda x, i: F.struct(i.alias("depth"), x.alias("facet")))


def library_class(code: Column) -> Column:
    """struct(section, shelf) of a classification code such as "PS"; nulls where the section doesn't exist."""
    letters = F.regexp_extract(F.upper(F.trim(code)), r"^([A-Z]{1,3})", 1)
    section = F.substring(letters, 1, 1)
    valid = section.isin(*CLASS_SECTIONS)
    return F.struct(F.when(valid, section).alias("section"), F.when(valid, letters).alias("shelf"))


def number_in_file_name(path: Column) -> Column:
    """The number of a text file such as ``a/pg123-0.txt``."""
    return F.regexp_extract(F.lower(path), r"(?:^|/)(?:pg)?(\d+)(?:-\d+)?\.txt$", 1).try_cast("bigint")


def without_markdown(text: Column) -> Column:
    """Text of links, no images, tags, entities or emphasis; squeezed."""
    s = F.regexp_replace(text, r"!\[[^\]]*\]\([^)]*\)", " ")
    s = F.regexp_replace(s, r"\[([^\]]*)\]\([^)]*\)", "$1")
    s = F.regexp_replace(F.regexp_replace(s, r"<[^>]+>", " "), r"&[a-z]+;|&#\d+;", " ")
    return squeeze(F.regexp_replace(s, r"[*_`]+", ""))


def has_term(text: Column, term: str) -> Column:
    """Whether lower-case ``text`` holds ``term``: as a whole word, or anywhere if the term has a blank or punctuation."""
    term = term.lower()
    if any(c in term for c in " -.+#"):
        return F.contains(text, F.lit(term))
    return text.rlike(rf"(?<![a-z0-9]){term}(?![a-z0-9])")


def truncated(text: Column, length: int) -> Column:
    """At most ``length`` characters, the last an ellipsis where something is cut off."""
    return F.when(F.length(text) > length, F.concat(F.rtrim(F.substring(text, 1, length - 1)), F.lit("…"))).otherwise(text)


def content_words(text: Column, stop: list[str], least: int = 4) -> Column:
    """Words of a-z, 0-9 and _ of at least ``least`` characters in lower case, each once, without stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"([a-z0-9_]{{{least},}})"))
    return F.array_except(words, F.array(*[F.lit(s) for s in stop]).cast("array<string>"))


def team_organisation(login: Column) -> Column:
    """The organisation of a team login ``github:org:team``; null for other logins."""
    parts = F.split(login, ":")
    return F.when((F.size(parts) >= 3) & (parts[0] == "github") & (parts[1] != ""), parts[1])


def place(raw: Column, aliases: dict[str, str], countries: dict[str, str], noise: list[str]) -> Column:
    """struct(place, country) of a typed place: alias and country by table, nulls for noise and over 60 characters."""
    s = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"[​-‏﻿]", "")
    s = squeeze(F.regexp_replace(F.trim(s), r"^[^\w]+|[^\w)]+$", ""))
    s = F.when((s != "") & (F.length(s) <= 60) & ~s.isin(*noise), s)
    s = F.coalesce(lookup(s, aliases), s)
    nations = sorted(set(countries.values()))
    return F.struct(s.alias("place"), F.when(s.isin(*nations), s).otherwise(lookup(s, countries)).alias("country"))


def organisation(raw: Column, noise: list[str]) -> Column:
    """A typed employer: without @, outer punctuation and legal suffix; null for noise and over 60 characters."""
    s = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"[​-‏﻿]", "")
    s = squeeze(F.regexp_replace(F.regexp_replace(F.trim(s), r"^@+", ""), r"^[^\w]+|[^\w)]+$", ""))
    s = F.regexp_replace(s, r"[,.]?\s*(?:inc|llc|ltd|gmbh|corp|co)\.?$", "")
    return F.when((s != "") & (F.length(s) <= 60) & ~s.isin(*noise), s)


def lookup(value: Column, mapping: dict[str, str]) -> Column:
    """``mapping[value]``, null where it isn't in the mapping."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[value]
