"""Variant spellings of names typed by people: rows that denote one person or one organisation.

Method: block by phonetic codes of sorted tokens, compare with Jaro-Winkler and a table of nicknames, cluster
the accepted pairs by connected components.

- A name is read into surname, given name and further given names (or the words of an organisation) from both of its
  columns: titles, quotes, order, case, accents, Cyrillic, handles and legal forms are undone. Which words are
  given names, and which are ordinary words of organisations, is learned from all rows.
- Rows that read the same are one; only their different readings are compared. Blocks are the sorted codes of
  surname and initial, where a code is the word's consonants by sound, or the word with one consonant left out,
  so that a typing error in the surname still meets, also a consonant in place of a vowel; and the sorted codes of
  surname and given name without its first letter, so that one there does. Bodies have such blocks for every word. Blocks above a bound are divided by
  year of birth and spread over several tasks.
- A pair is accepted if its names agree and nothing contradicts. Two words agree by nickname, by sound, or from a
  Jaro-Winkler score of ``SAME_WORD`` (long ones ``SAME_LONG_WORD``) on, which decides alone. Years differ by one at most, further given names don't
  differ. A reading without year, or with only an initial, that would agree with readings that contradict one
  another, is not linked to any of them.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.groups import connected_groups
from quillmesh.storage import cut_lineage, pick, spread

#: A word must be this share of all rows, and this many, to count as a known given name or a common word.
GIVEN_SHARE, GIVEN_ROWS = 2e-4, 3
COMMON_SHARE, COMMON_ROWS = 0.01, 8
#: Readings in a block from which on it is divided by year.
LARGE_BLOCK = 200
#: Readings of a large block that one task holds.
SALTED_ROWS = 2000
#: Jaro-Winkler from which on two words are spellings of one: one error costs a long word less.
SAME_WORD, SAME_LONG_WORD = 0.9, 0.94
LONG_WORD = 8
#: Words or readings of which a worker keeps what it found.
KEPT = 30_000
#: In place of a given name: the word before it is the whole name.
WHOLE = "="

# Nicknames and the names they stand for.
NICKNAMES = {
    "abby": "abigail", "alex": "alejandro alexander alexandra", "andy": "andrew", "becky": "rebecca", "ben": "benjamin", "bert": "albert robert", "bess": "elizabeth",
    "beth": "elizabeth", "betsy": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert",
    "charlie": "charles", "chris": "christopher christina", "cathy": "catherine", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah",
    "debbie": "deborah", "dick": "richard", "dima": "dmitri", "don": "donald", "dora": "dorothea theodora", "dot": "dorothy", "ed": "edward edmund",
    "eddie": "edward", "eliza": "elizabeth", "fran": "frances francis", "frank": "francis franklin", "fred": "frederick", "gabi": "gabriela",
    "gabby": "gabriela", "greg": "gregory", "hannes": "johannes", "hans": "johannes", "harry": "harold henry", "jack": "john", "jake": "jacob",
    "jan": "johannes janet", "jandro": "alejandro", "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald jerome", "jim": "james",
    "jimmy": "james", "joe": "joseph", "joey": "joseph", "johnny": "john", "jon": "jonathan", "josh": "joshua", "kate": "katherine catherine",
    "kathy": "katherine catherine", "katie": "katherine", "kit": "christopher", "kitty": "katherine", "larry": "laurence lawrence", "leo": "leonardo leonard leopold",
    "liz": "elizabeth", "lizzie": "elizabeth", "maggie": "margaret", "meg": "margaret", "mike": "michael", "mick": "michael", "mickey": "michael",
    "misha": "mikhail", "molly": "mary", "nat": "nathaniel natalie", "ned": "edward", "nell": "eleanor helen", "nick": "nicholas", "nicky": "nicholas",
    "paco": "francisco", "pancho": "francisco", "pat": "patrick patricia", "peg": "margaret", "peggy": "margaret", "pete": "peter", "polly": "mary",
    "ray": "raymond", "rick": "richard", "ricky": "richard", "rob": "robert", "robbie": "robert", "ron": "ronald", "sam": "samuel samantha",
    "sandy": "alexander", "sanne": "susanne", "sasha": "alexander alexandra", "steph": "stephanie", "steve": "stephen steven", "sue": "susan susanne",
    "susie": "susan susanne", "ted": "edward theodore", "teddy": "edward theodore", "theo": "theodore", "tim": "timothy", "toby": "tobias", "tom": "thomas",
    "tommy": "thomas", "tony": "anthony", "vicky": "victoria", "vince": "vincent", "walt": "walter", "will": "william", "willy": "william", "zach": "zachary",
}
# Titles and suffixes, without periods.
TITLES = frozenset("dr prof professor mx mr mrs ms miss sir dame lord lady rev hon herr frau mme mlle don dona fr sr sra ing".split())
SUFFIXES = frozenset("jr sr ii iii iv phd md esq".split())
PARTICLES = frozenset("van von der den de la le du del della di da dos das do al el bin ibn ter ten zu zum".split())
# Short and long forms of legal forms and kinds of body.
BODIES = {
    "assn": "association", "assoc": "association", "asso": "association", "ass": "association", "co": "company", "comp": "company", "corp": "corporation",
    "dept": "department", "dep": "department", "fdn": "foundation", "found": "foundation", "fndn": "foundation", "inst": "institute", "lab": "laboratories",
    "labs": "laboratories", "laboratory": "laboratories", "ltd": "limited", "soc": "society", "u": "university", "uni": "university", "univ": "university",
    "ctr": "center", "centre": "center", "natl": "national", "intl": "international", "acad": "academy", "coll": "college", "bros": "brothers", "mus": "museum",
}
LEGAL = frozenset("inc incorporated llc plc gmbh ag sa bv nv".split())
SMALL_WORDS = frozenset("the of and for a an de la le des und der die y et".split())
# Cyrillic letters in Latin script.
CYRILLIC = str.maketrans(
    {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "j", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n",
     "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sh", "ъ": "", "ы": "i", "ь": "",
     "э": "e", "ю": "iu", "я": "ia", "і": "i", "ї": "i", "є": "e", "ґ": "g"}
)
LATIN = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"})
SOUNDS = str.maketrans({"c": "k", "q": "k", "x": "k", "w": "v", "y": "i", "ß": "s"})
VOWELS = frozenset("aeiou")
NO_VOWELS = str.maketrans("", "", "aeiou")
DOUBLED = re.compile(r"(.)\1+", re.DOTALL)

QUOTED = regex.compile(r"[\"“”„«»](.*?)[\"“”„«»]")
IN_BRACKETS = regex.compile(r"\([^)]*\)")
HAS_CYRILLIC = regex.compile(r"\p{Cyrillic}")
TWO_INITIALS = regex.compile(r"(?<![\w.])(\p{Lu})(\p{Lu})(?![\w.'’-])")
ACRONYM = regex.compile(r"\p{Lu}{1,5}|(?:\p{Lu}\.){1,5}")
HANDLE = regex.compile(r"^([^\W\d_]+)([._])([^\W\d_]+)$")


def folded(text: str) -> str:
    """Lower case without accents, in Latin letters, white space squeezed."""
    if text.isascii():
        return " ".join(text.lower().split())
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).lower().translate(CYRILLIC))
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).translate(LATIN).replace("​", "").replace("﻿", "").split())


@lru_cache(maxsize=KEPT)
def by_sound(word: str) -> str:
    """The word in letters of one sound, doubled letters once."""
    return DOUBLED.sub(r"\1", word.translate(SOUNDS))


@lru_cache(maxsize=KEPT)
def skeleton(word: str) -> str:
    """Its first letter, if a vowel as "a", and its consonants by sound."""
    sound = by_sound(word)
    return ("a" if sound[:1] in VOWELS else sound[:1]) + DOUBLED.sub(r"\1", sound[1:].translate(NO_VOWELS))


def without_one_consonant(word: str) -> set[str]:
    """The word, and it with any one consonant left out."""
    sound = by_sound(word)
    return {sound, *(by_sound(sound[:i] + sound[i + 1 :]) for i, c in enumerate(sound) if c not in VOWELS)}


@lru_cache(maxsize=KEPT)
def shorter_skeletons(word: str) -> frozenset[str]:
    """The skeletons of the word with one consonant left out, but for its own."""
    sound = by_sound(word)
    return frozenset(skeleton(sound[:i] + sound[i + 1 :]) for i, c in enumerate(sound) if c not in VOWELS) - {skeleton(word)}


def jaro_winkler(a: str, b: str, *, in_place: bool = False) -> float:
    """1 for equal words, 0 for words without common letters. A letter is matched with the first free one within reach; with
    ``in_place`` those that stand in the same place are matched before, which tells more where letters recur."""
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    same = [in_place and x == y for x, y in zip(a, b)]
    used = same + [False] * (len(b) - len(same))
    matched_a = []
    for i, c in enumerate(a):
        if i < len(same) and same[i]:
            matched_a.append(c)
            continue
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                matched_a.append(c)
                break
    m = len(matched_a)
    if not m:
        return 0.0
    matched_b = [c for j, c in enumerate(b) if used[j]]
    swaps = sum(x != y for x, y in zip(matched_a, matched_b)) / 2
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return score + prefix * 0.1 * (1 - score)


@lru_cache(maxsize=KEPT)
def same_word(a: str, b: str) -> bool:
    """One word, but for a typing error: equal, equal by sound, or alike by Jaro-Winkler; words under four letters aren't alike."""
    if a == b or by_sound(a) == by_sound(b):
        return True
    shorter = min(len(a), len(b))
    return shorter >= 4 and likeness(a, b) >= (SAME_LONG_WORD if shorter >= LONG_WORD else SAME_WORD)


def likeness(a: str, b: str) -> float:
    """Jaro-Winkler at its highest: read forwards or backwards, since it favours equal beginnings and an early error would count
    more than a late one; and by either way of matching."""
    back = a[::-1], b[::-1]
    return max(jaro_winkler(a, b), jaro_winkler(*back), jaro_winkler(a, b, in_place=True), jaro_winkler(*back, in_place=True))


class Words:
    """What the rows teach: ``givens``, known given names; ``common``, ordinary words of organisations."""

    def __init__(self, givens=(), common=()):
        self.givens, self.common = frozenset(givens), frozenset(common)


def human_forms(text: str | None, words: Words) -> list[tuple[str, str, str]]:
    """Possible (surname, given, further given names) of one spelling, folded; they may be initials or missing. A single word
    that can't be a handle is (word, "=", ""): it is compared as a whole."""
    if not text or not text.strip():
        return []
    nick, plain = "", text
    if not text.isascii() or '"' in text:
        if m := QUOTED.search(text):
            nick = folded(m.group(1))
        plain = QUOTED.sub(" ", text)
    if "(" in plain:
        plain = IN_BRACKETS.sub(" ", plain)
    if not plain.isupper():  # "ND Name": two initials
        plain = TWO_INITIALS.sub(r"\1 \2", plain)
    s = folded(plain)
    if m := HANDLE.match(s):
        a, mark, b = m.groups()
        return [(a, b, ""), (b, a, "")] if not (a in words.givens or b in words.givens) else [(b, a, "")] if a in words.givens else [(a, b, "")]
    surname, comma, rest = s.partition(",")
    if comma:
        last = _tokens(surname)
        first = [t for t in _tokens(rest) if t not in TITLES and t not in SUFFIXES]
        if last and first:
            return [("".join(last), first[0], " ".join(first[1:]))]
        tokens = last or first
    else:
        tokens = _tokens(s)
    while len(tokens) > 1 and tokens[0] in TITLES:
        tokens = tokens[1:]
    while len(tokens) > 2 and tokens[-1] in SUFFIXES:
        tokens = tokens[:-1]
    if not tokens:
        return []
    if len(tokens) == 1:
        t = tokens[0]
        return [(t[1:], t[0], ""), (t[:-1], t[-1], "")] if len(t) >= 5 and t.isascii() and not comma and t not in words.givens else [(t, WHOLE, "")]
    while len(tokens) > 2 and tokens[-2] in PARTICLES:
        tokens = [*tokens[:-2], tokens[-2] + tokens[-1]]
    if len(tokens[-1]) == 1:
        return [(tokens[0], tokens[-1], "")]
    middle = " ".join(tokens[1:-1])
    plain = (tokens[-1], tokens[0], middle)
    if len(tokens) == 2 and len(tokens[0]) > 1 and tokens[0] not in words.givens:
        turned = (tokens[0], tokens[1], "")
        return [turned] if tokens[1] in words.givens else [plain, turned]
    return [plain] if not nick else [plain, (tokens[-1], nick, "")]


def _tokens(text: str) -> list[str]:
    return regex.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text)


def body_words(text: str | None) -> tuple[list[str], str]:
    """The words of an organisation's name, legal and small words left out, in the order proper name, fields, kind; and
    a single word in capitals that may be an acronym or a handle."""
    if not text or not text.strip():
        return [], ""
    s = IN_BRACKETS.sub(" ", text).replace("&", " and ").replace("-", " ")
    tokens = regex.findall(r"[\w']+", folded(s.replace(".", "")))
    tokens = [BODIES.get(t, t) for t in tokens]
    while tokens and tokens[0] == "the":
        tokens = tokens[1:]
    while len(tokens) > 2 and tokens[-1] in LEGAL:
        tokens = tokens[:-1]
    if "of" in tokens[1:-1]:  # "Name Institute of Data": kind before field
        at = tokens.index("of", 1)
        if at >= 2:
            tokens = [*tokens[: at - 1], *tokens[at + 1 :], tokens[at - 1]]
    kept = [t for t in tokens if t not in SMALL_WORDS]
    if len(kept) == 1:
        return [], kept[0]
    return kept, ""


def handles_of(text: str | None) -> set[str]:
    """What a body may be called in one word: its proper name and the initials of the rest, of all or without "and ..."."""
    words, _ = body_words(text)
    if len(words) < 3:
        return set()
    short = body_words(regex.sub(r"(?i)\s+(?:and|&)\s+\w+", " ", text))[0]
    return {w[0] + "".join(t[0] for t in w[1:]) for w in (words, short) if len(w) >= 2}


def reading(kind: str, name: str | None, sort_name: str | None, birth: int | None, death: int | None, words: Words) -> str | None:
    """All that matching knows of a row, as text; equal for rows that read the same. None if there is no name in it."""
    if kind == "organisation":
        forms = sorted({tuple(sorted(w)) for t in (name, sort_name) if len(w := body_words(t)[0]) >= 2})
        handles = sorted(handles_of(name) | handles_of(sort_name))
        if not forms:
            single = sorted({body_words(t)[1] for t in (name, sort_name) if t and not ACRONYM.fullmatch(t.strip())} - {""})
            if not single:
                return None
            return json.dumps(["o", [], single, birth, death])
        return json.dumps(["o", forms, handles, birth, death])
    by_order = human_forms(sort_name, words)
    by_name = by_order if name == sort_name else human_forms(name, words)
    if len(by_order) == 1 and len(by_name) > 1:  # the unambiguous spelling tells the order of the other
        surname = by_order[0][0]
        by_name = [f for f in by_name if same_word(f[0], surname)] or by_order
    elif len(by_name) == 1 and len(by_order) > 1:
        by_order = [f for f in by_order if same_word(f[0], by_name[0][0])] or by_name
    forms = by_order + [f for f in by_name if f not in by_order]
    if not forms:
        return None
    full = sorted({g for _, g, _ in forms if len(g) > 1})
    out = set()
    for surname, given, middle in forms:
        if given == WHOLE:
            out.add((surname, given))
            continue
        if len(surname) < 2:
            continue
        if len(given) == 1 and len({f[0] for f in forms if not same_word(f[0], surname)}) == 0:
            longer = [g for g in full if given in initials(g)]
            given = longer[0] if longer else given
        out.add((surname, given))
    if any(g != WHOLE for _, g in out):  # the other column says more than a single word
        out = {(s, g) for s, g in out if g != WHOLE}
    middle = max((m for _, _, m in forms), key=lambda m: (m.count(" "), len(m), m))
    return json.dumps(["h", sorted(out), middle.split(), birth, death]) if out else None


@lru_cache(maxsize=KEPT)
def formal(given: str) -> frozenset[str]:
    """The name itself, and those it may be a nickname of."""
    return frozenset((given, *NICKNAMES.get(given, "").split()))


@lru_cache(maxsize=KEPT)
def initials(given: str) -> frozenset[str]:
    return frozenset(g[0] for g in formal(given))


def keys_of(text: str, words: Words) -> list[str]:
    """The blocks of a reading: sorted codes of its words."""
    what, forms, more, _, _ = parsed(text)
    keys = set()
    if what == "h":
        for surname, given in forms:
            if given == WHOLE:
                keys.add(f"s:{surname}")
                continue
            for first in {by_sound(i) for i in initials(given)} if given else {""}:
                keys.add("h:" + "|".join(sorted((first, skeleton(surname)))))
                keys.update(f"h:{first}|{code}" for code in without_one_consonant(surname))
            if tail := skeleton(given)[1:] if len(given) > 1 else "":  # an error in the first letter of the given name
                keys.add("t:" + "|".join(sorted((skeleton(surname), tail))))
        return sorted(keys)
    for form in forms:
        keys.add("o:" + "|".join(sorted(skeleton(w) for w in form)))
        for word in set(form):  # also the common ones: a mistyped one isn't common
            rest = list(form)
            rest.remove(word)
            keys.update("o:" + "|".join([*rest, code]) for code in without_one_consonant(word))
    keys.update("w:" + by_sound(w) for w in more)
    return sorted(keys)


def looks_of(text: str) -> list[str]:
    """Blocks in which a reading looks for others without being found there by readings that only look, too: those it would have
    if a consonant in it stood for a vowel, or were too many."""
    what, forms, _, _, _ = parsed(text)
    looks = set()
    if what == "h":
        for surname, given in forms:
            if given != WHOLE:
                for first in {by_sound(i) for i in initials(given)} if given else {""}:
                    looks.update("h:" + "|".join(sorted((first, code))) for code in shorter_skeletons(surname))
    else:
        for form in forms:
            for i, word in enumerate(form):
                rest = [skeleton(w) for w in (*form[:i], *form[i + 1 :])]
                looks.update("o:" + "|".join(sorted((*rest, code))) for code in shorter_skeletons(word))
    return sorted(looks)


def years_agree(a: int | None, b: int | None) -> bool:
    return a is None or b is None or abs(a - b) <= 1


def same_given(a: str, b: str, words: Words) -> bool:
    if WHOLE in (a, b):
        return a == b
    if not a or not b:
        return True
    if len(a) == 1 or len(b) == 1:
        return bool(initials(a) & initials(b)) or by_sound(a[0]) == by_sound(b[0])
    if by_sound(a) == by_sound(b) or formal(a) & formal(b):
        return True
    if a in words.givens and b in words.givens:
        return False
    return any(same_word(x, y) for x in formal(a) for y in formal(b))


def same_middle(a: list[str], b: list[str]) -> bool:
    """Whether further given names, one by one as far as both have them, don't differ; an initial stands for its names."""
    return all(x[0] == y[0] if len(x) == 1 or len(y) == 1 else same_word(x, y) for x, y in zip(a, b))


@lru_cache(maxsize=KEPT)
def parsed(text: str) -> list:
    return json.loads(text)


def agree(a: str, b: str, words: Words) -> bool:
    """Whether two readings may be of one person or body."""
    x, y = parsed(a), parsed(b)
    if x[0] != y[0] or not years_agree(x[3], y[3]) or not years_agree(x[4], y[4]):
        return False
    if x[0] == "h":
        if not same_middle(x[2], y[2]):
            return False
        return any((s == t if g == WHOLE else same_word(s, t)) and same_given(g, h, words) for s, g in x[1] for t, h in y[1])
    if not x[1] or not y[1]:
        return any(v == w or (min(len(v), len(w)) >= 6 and same_word(v, w)) for v in x[2] for w in y[2])
    return any(same_words(v, w, words) for v in x[1] for w in y[1])


def same_words(a: list[str], b: list[str], words: Words) -> bool:
    """Equal words but for one typing error in one of them that isn't an ordinary word in both."""
    if len(a) != len(b):
        return False
    only_a, only_b = list((Counter(a) - Counter(b)).elements()), list((Counter(b) - Counter(a)).elements())
    if not only_a:
        return True
    if len(only_a) != 1:
        return False
    v, w = only_a[0], only_b[0]
    return not (v in words.common and w in words.common) and same_word(v, w)


def count_words(rows: DataFrame) -> DataFrame:
    """(role, word, n): given names and surnames where a comma tells them, words of bodies, and rows of either kind."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for kind, name, sort_name in zip(*(c.to_pylist() for c in batch.columns)):
                counts[kind, ""] += 1
                if kind == "organisation":
                    counts.update(("body", w) for w in set(body_words(sort_name or name)[0]))
                    continue
                for text in (name, sort_name):
                    surname, comma, given = folded(text).partition(",") if text else ("", "", "")
                    if comma and (tokens := _tokens(given)):
                        counts["given", tokens[0]] += 1
                        counts.update(("surname", t) for t in _tokens(surname))
                        break
            if len(counts) > 200_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    return rows.mapInArrow(count, "role string, word string, n long").groupBy("role", "word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())],
        names=["role", "word", "n"],
    )


def learn_words(rows: DataFrame) -> Words:
    """Known given names and common words: those of at least a share of all rows, so at most 1 / share of a role
    (times the words of a name) reach the driver."""
    counts = count_words(rows).groupBy("word").pivot("role", ["human", "organisation", "given", "surname", "body"]).sum("n").na.fill(0)
    counts = cut_lineage(counts)
    totals = counts.agg(F.sum("human"), F.sum("organisation")).first()
    humans, bodies = totals[0] or 0, totals[1] or 0
    common = F.col("n_word") >= max(COMMON_ROWS, COMMON_SHARE * bodies)
    renamed = counts.toDF("text", "human", "organisation", "given", "surname", "n_word")
    given = (F.col("given") >= max(GIVEN_ROWS, GIVEN_SHARE * humans)) & (F.col("given") > 3 * F.col("surname")) & (F.length("text") > 1)
    kept = renamed.filter("text <> ''").select("text", given.alias("is_given"), common.alias("is_common")).filter("is_given or is_common").collect()
    return Words([r["text"] for r in kept if r["is_given"]], [r["text"] for r in kept if r["is_common"]])


def link_names(df: DataFrame, *, key: str = "person_id", name: str = "name", sort_name: str = "sort_name", kind: str = "kind", birth: str = "birth_year", death: str = "death_year") -> DataFrame:
    """Groups of rows that are spellings of one person or one organisation: key, group_id (the smallest key).

    Rows of kind human or organisation (in any case, with blanks around) take part, each key once; of rows with
    one key and different values the greatest by name, sort_name, birth and death counts. Rows without a key,
    without a name in either column, or with nothing but an acronym of a body (up to five capitals), are in no group;
    nor are rows that nothing is linked to. Two rows that read the same are linked. A person's single word that can't
    be a handle (under five letters, a known given name, no Latin letters) links only to the same word. An empty
    table gives no rows. Of further columns nothing is read.

    Runs jobs: the words, the readings, the candidates and the groups are written to the checkpoint folder.
    """
    rows = pick(df, key=key, name=name, sort_name=sort_name, kind=kind, birth=birth, death=death)
    rows = rows.withColumn("kind", F.lower(F.trim("kind"))).filter("key is not null and kind in ('human', 'organisation')")
    value = F.struct("name", "sort_name", F.col("birth").cast("long").alias("birth"), F.col("death").cast("long").alias("death"), "kind")
    rows = rows.groupBy("key").agg(F.max(value).alias("v")).select("key", "v.*")
    rows = cut_lineage(rows)
    words = learn_words(rows.select("kind", "name", "sort_name"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [reading(*values, words) for values in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "reading"])

    key_kind = rows.schema["key"].dataType.simpleString()
    read_rows = spread(rows.select("key", "kind", "name", "sort_name", "birth", "death")).mapInArrow(read, f"key {key_kind}, reading string")
    read_rows = cut_lineage(read_rows.filter("reading is not null"))
    # Numbers stand for the readings until their pairs are compared: they sort and shuffle faster than keys.
    readings = cut_lineage(read_rows.groupBy("reading").agg(F.min("key").alias("key_of")).withColumn("id", F.monotonically_increasing_id()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            births = [parsed(t)[3] for t in texts]
            found = [[(k, True) for k in keys_of(t, words)] + [(k, False) for k in looks_of(t)] for t in texts]
            ends = [0]
            for keys in found:
                ends.append(ends[-1] + len(keys))
            flat = [k for keys in found for k in keys]
            entries = pa.StructArray.from_arrays([pa.array([k for k, _ in flat], pa.string()), pa.array([f for _, f in flat], pa.bool_())], names=["block", "full"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(births, pa.int64()), lists], names=["id", "birth", "blocks"])

    blocked = spread(readings.select("id", "reading")).mapInArrow(blocks, "id long, birth long, blocks array<struct<block:string,full:boolean>>")
    # The block's hash is enough: where two blocks share one, more pairs are compared.
    blocked = cut_lineage(blocked.select("id", "birth", F.inline("blocks")).select("id", "birth", F.xxhash64("block").alias("block"), "full"))
    sizes = blocked.groupBy("block").agg(F.count("*").alias("size"), F.max("full").alias("_any")).filter("size > 1 and _any").drop("_any")
    blocked = cut_lineage(blocked.join(sizes, "block"))  # most blocks have one reading, and are gone
    biggest = blocked.agg(F.max("size")).first()[0] or 0
    a, b = blocked.alias("a"), blocked.alias("b")
    near = F.expr("a.birth is null or b.birth is null or abs(a.birth - b.birth) <= 1")
    small = a.filter(F.col("size") <= LARGE_BLOCK).join(b.filter(F.col("size") <= LARGE_BLOCK), F.expr("a.block = b.block and a.id < b.id and (a.full or b.full)") & near)
    pairs = small.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    if biggest > LARGE_BLOCK:
        pairs = pairs.union(_pairs_of_large_blocks(blocked))
    pairs = pairs.distinct()

    sides = [readings.select(F.col("id").alias(s), F.col("key_of").alias(f"key_{s}"), F.col("reading").alias(f"reading_{s}")) for s in ("a", "b")]
    candidates = pairs.join(sides[0], "a").join(sides[1], "b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "reading_a", "reading_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array([agree(x, y, words) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield batch.filter(mask)

    accepted = candidates.mapInArrow(compare, f"a {key_kind}, b {key_kind}, reading_a string, reading_b string")
    accepted = cut_lineage(_unambiguous(cut_lineage(accepted), words))
    copies = read_rows.join(readings, "reading").filter(F.col("key") != F.col("key_of")).select(F.col("key").alias("a"), F.col("key_of").alias("b"))
    return connected_groups(accepted.select("a", "b").union(copies), a="a", b="b").withColumnRenamed("vertex", "key")


def _pairs_of_large_blocks(blocked: DataFrame) -> DataFrame:
    """Pairs (a, b) of the blocks above the bound: a year meets itself and the next, a reading without year meets all. Both the
    readings at home and those that come to look are spread over as many tasks as the block's size asks for."""
    large = blocked.filter(F.col("size") > LARGE_BLOCK).withColumn("salts", F.ceil(F.col("size") / SALTED_ROWS).cast("int"))
    home = large.select("id", "block", "full", F.col("birth").alias("at"), F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"))
    dated = large.filter("birth is not null").select("id", "block", "full", "birth", "salts", F.explode(F.array("birth", F.col("birth") + 1)).alias("at"))
    dated = dated.select("id", "block", "full", "salts", "at", (F.col("at") > F.col("birth")).alias("any"))
    undated = large.select("id", "block", "full", "salts", F.lit(None).cast("long").alias("at"), F.col("birth").isNotNull().alias("any"))
    looks = dated.union(undated).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("look")
    met = home.alias("home").join(looks, F.expr("home.block = look.block and home.salt = look.salt and home.at <=> look.at and (home.full or look.full) and (look.any or home.id < look.id)"))
    ends = [f("home.id", "look.id") for f in (F.least, F.greatest)]
    return met.select(ends[0].alias("a"), ends[1].alias("b"))


def _unambiguous(accepted: DataFrame, words: Words) -> DataFrame:
    """Pairs without those of a weak reading (no year of birth, or only an initial) whose partners contradict one another."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"id": [], "weak": [], "birth": [], "death": [], "given": [], "middle": []}
            a, b, ra, rb = (c.to_pylist() for c in batch.columns)
            for x, y, own, other in [*zip(a, b, ra, rb), *zip(b, a, rb, ra)]:
                o, p = parsed(own), parsed(other)
                one_letter = o[0] == "h" and all(len(g) <= 1 for _, g in o[1])
                known = sorted({by_sound(f) for _, g in p[1] for f in formal(g) if f in words.givens}) if p[0] == "h" else []
                out["id"].append(x)
                out["weak"].append(o[3] is None or one_letter)
                out["birth"].append(p[3])
                out["death"].append(p[4])
                out["given"].append(known[0] if one_letter and known else None)
                out["middle"].append(p[2][0][0] if p[0] == "h" and p[2] and not o[2] else None)
            kinds = [batch.schema.field(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    kind = accepted.schema["a"].dataType.simpleString()
    seen = accepted.mapInArrow(sides, f"id {kind}, weak boolean, birth long, death long, given string, middle string").filter("weak")
    per = seen.groupBy("id").agg(
        *[(F.max(c) - F.min(c) > 2).alias(c) for c in ("birth", "death")], *[(F.max(c) > F.min(c)).alias(c) for c in ("given", "middle")]
    )
    doubtful = cut_lineage(per.filter("birth or death or given or middle").select("id"))
    kept = accepted.join(doubtful.withColumnRenamed("id", "a"), "a", "left_anti")
    return kept.join(doubtful.withColumnRenamed("id", "b"), "b", "left_anti").select("a", "b", "reading_a", "reading_b")


def pairs_within(groups: DataFrame, *, key: str = "key", group: str = "group_id") -> DataFrame:
    """All pairs inside the groups: a < b, each once. The result grows with the square of a group, as it is asked for."""
    x = groups.select(F.col(group).alias("g"), F.col(key).alias("a"))
    y = groups.select(F.col(group).alias("g"), F.col(key).alias("b"))
    return x.join(y, "g").filter("a < b").select("a", "b")
