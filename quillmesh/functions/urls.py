"""Normal forms of repository addresses and other URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repository_name(text: Column) -> Column:
    """Plain ``owner/name`` in lower case of a repository written in any way; null where there is none.

    Understands ``owner/name``, web and git addresses with or without ``git+``, scheme, user, ``www.``,
    query, fragment, ``.git`` and closing slash, and drops white space and punctuation around them.
    """
    plain = text.rlike(r"^[a-z0-9_-]+/[a-z0-9_-]+$")  # most are: they need none of the replacements

    def cleaned(t: Column) -> Column:
        s = F.lower(F.regexp_replace(t, r"^[\s <(\[\"']+|[\s >)\]\"',;.]+$", ""))
        s = F.regexp_replace(s, r"^(?:git\+)?(?:[a-z][a-z0-9+.-]*://)?(?:[^/@\s]+@)?(?:www\.)?github\.com[/:]+", "")
        s = F.regexp_replace(F.regexp_replace(s, r"[?#].*$", ""), r"(?:\.git|[/.,;)>\s])+$", "")
        return F.regexp_extract(s, r"^([^/\s:@]+/[^/\s]+)", 1)

    # Within a lambda the replacements run for the others only; elsewhere generated code computes them for every row.
    made = F.element_at(F.transform(F.when(~plain, F.array(text)), cleaned), 1)
    return F.when(plain, text).when(made != "", made)


def clean_url(text: Column) -> Column:
    """Trimmed, without angle brackets, closing punctuation and ``git+``."""
    s = F.regexp_replace(F.trim(text), r"^<+|>+$", "")
    return F.regexp_replace(F.regexp_replace(s, r"[).,;]+$", ""), r"^git\+", "")


def normalized_repository_url(text: Column) -> Column:
    """``https://host/owner/name`` in lower case, without ``www.`` and ``.git``; null without two path segments or with blanks."""
    shape = r"^(?:[a-z][a-z0-9+.-]*://)?(?:www\.)?([^/?#\s:]+(?::\d+)?)/+([^/?#\s]+)/+([^/?#\s]+?)(?:\.git)?(?:[/?#]\S*)?$"
    made = F.regexp_replace(F.lower(clean_url(text)), shape, "https://$1/$2/$3")
    return F.when(made.rlike(r"^https://[^/?#\s]+/[^/?#\s]+/[^/?#\s]+$"), made)


def provisional_id(url: Column) -> Column:
    return F.concat(F.lit("provisional:"), F.sha2(url, 256))


def repository_from_url(text: Column) -> Column:
    """``owner/name`` after ``github.com/`` or ``github.com:`` in lower case, without ``.git``; null where there is none."""
    s = F.regexp_extract(F.lower(text), r"github\.com[/:]([^/\s]+/[^/\s?#]+)", 1)
    return F.when(s != "", F.regexp_replace(s, r"\.git$", ""))
