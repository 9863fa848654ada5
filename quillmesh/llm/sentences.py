"""Sentence boundaries across languages and scripts, as places in the text.

Method: document-centred disambiguation. A period after a word is ambiguous; what the word is - an
abbreviation or an ordinary word - and whether the capitalised word behind it is a name or begins a sentence is
taken from their unambiguous occurrences elsewhere in the document: a period that a small letter or a comma
follows, the word without period, the same word in small letters, a capital in the midst of a sentence. Where
the document says nothing the corpus does, and where it doesn't either, short lists of abbreviations.
Terminators are those of the script: full stops of Chinese and Japanese, Devanagari, Arabic, Urdu, Armenian,
Burmese and Ethiopic text are clear by themselves, the Greek question mark is a semicolon, Thai and Lao end
sentences with a blank between letters.

Layout comes first: blank lines end paragraphs; fenced code, headings and paragraphs without sentences are one
unit each; list items start a unit. Within a paragraph nothing ends inside a quotation or a bracket, and a
quotation and the clause that goes with it stay together, however long they are.

Size: two passes over the texts, each row on its own. The first counts words in each task and adds the counts
by word; words below a share of all words are left out of the lexicon, so it can't have more than 1 / share
entries, however large the corpus, and is broadcast. As a share the bound is the same at every size.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.storage import cut_lineage, pick, spread

#: A word (in one of its roles) must be this share of all words to enter the lexicon: at most 500,000 can.
LEAST_SHARE = 2e-6
#: Up to this length a text is searched for a word before all of its words are counted: the result is the same.
SHORT_TEXT = 1 << 16
#: Characters whose words a task counts before it sends the counts on.
COUNTED_CHARS = 1 << 24

# Abbreviations in lower case without their last period, the last resort where neither document nor
# corpus tells. Titles, which count with a capital:
TITLES = frozenset("adm capt cmdr col fr gen gov hon hr lt m maj mgr mlle mme mr mrs ms mt mx rep res rev sen sgt sgog st ste".split())
# References, which a number or a single letter follows:
REFERENCES = frozenset(
    "app art bd cap ch chap col fig figs jg kap lic min no nos nro nr núm núms op p pag par pg pl pp pág págs r ref sec sect tab tel vol vols "
    "гл оз рис см стр ст табл тел σελ τηλ κεφ".split()
)
# Others that something always follows:
CONTINUING = frozenset(
    "al approx aprox avda bzgl bzw ca cf dept doc dr dra drs e.g ed eds env evtl exc geb i.e incl ing insb prof prof r sog sr sra sres srta str "
    "vgl viz vs z zzgl др-р им илл напр обл пер пл проф св ср тов ул αρ βλ δηλ κ κα κος λ.χ π.χ περ πρβλ χλμ डॉ रु श्री सं".split()
)
# Those that may also end a sentence:
MAY_END = frozenset(
    "a.m p.m a.d b.c u.s u.k u.n u.s.a d.c etc inc ltd co corp llc bros jr esq ff f al usw uvm dgl gmbh ag s.a s.l ee.uu u.a z.b "
    "jan feb mar apr jun jul aug sep sept oct nov dec av ave blvd rd "
    "г гг в вв др пр т.д т.п т.е н.э руб коп тыс млн млрд ч кг км м "
    "κ.λπ κλπ π.μ μ.μ μ.χ π.χ".split()
)
# Those of them that a name may follow, as part of a longer name:
BEFORE_NAMES = frozenset("u.s u.k u.n av ave blvd rd г в co jr".split())
# What turns a number before a period into an ordinal, in lower case.
BEFORE_ORDINAL = frozenset("am ab bis dem den der des die das im ihr ihren ihrer jedem jeden seit vom zum zur".split())
# Verbs of speech that tie a clause to the quotation before it where there is no case to tell.
HAN_SPEECH = regex.compile(r"[^。！？…，；“”「」]*?(?:说|問|问|道|答|喊|叫|写|表示|说道|回答)(?:着|了)?(?=[。！？…，]|$)")
KANA_QUOTE = regex.compile(r"(?:と|って|という|とは|などと|なんて)")
HANGUL_QUOTE = regex.compile(r"(?:이?라고|이?라며|이?라는|하고|하며|고 )")
AND_THEN = regex.compile(r"(?:और|तथा|तो|फिर|اور|پھر|و\p{Arabic}|و |ثم|ف\p{Arabic}{2})")
SPEECH_AFTER_NAME = regex.compile(r"(?:\p{Lu}[\p{L}.'’-]*\s+){1,3}(?:said|says|asked|asks|replied|added|answered)\b")

OPENERS = {"(": ")", "[": "]", "（": "）", "［": "］", "“": "”", "„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "【": "】", "《": "》", "〈": "〉", "〝": "〞〟"}
CLOSERS = frozenset("".join(OPENERS.values()) + "\"'’”)]}»›」』】》〉）］")
QUOTES = frozenset("\"“”„«»‹›「」『』〝〞〟")
FULL_STOPS = "。！？｡．؟۔।॥։။።፧᙮។៕"
BEFORE_CLOSER = frozenset(" \t\r\n  \"'’”»」』)）]")

TERMINATOR = regex.compile(rf"[.!?…‼⁇⁈⁉]+|[{FULL_STOPS}]+[{FULL_STOPS}…!?]*|[;;]")
LINE_END = regex.compile(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
FENCE = regex.compile(r"\s{0,3}(`{3,}|~{3,})")
HEADING = regex.compile(r"\s{0,3}#{1,6}(?:\s|$)")
BULLET = regex.compile(r"\s*[-*+•‣◦▪·][ \t ]+\S")
NUMBERED = regex.compile(r"\s*\(?(\d{1,4})[.)][ \t ]+\S")
RULE = regex.compile(r"\s*([=\-*_~#+])(?:\s*\1){2,}\s*$")
TABLE = regex.compile(r"\s*\|.*\|")
CHAPTER = regex.compile(r"(?i)\s*(?:chapter|part|section|book|appendix|kapitel|abschnitt|teil|chapitre|partie|capítulo|parte|sección|глава|часть|раздел|κεφάλαιο|μέρος)\b.*$")
WORD = regex.compile(r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}'’\-]*(?:\.[\p{L}\p{M}\p{N}]+)*")
FOLLOWING = regex.compile(rf"[\"'“„«‹(\[¿¡`]*({WORD.pattern})")
# Read backwards from a place: the run of characters of a word or address; the word before; a letter with its period.
RUN_BEFORE = regex.compile(r"(?r)[\p{L}\p{M}\p{N}'’.\-/_&+@:=#]*")
PREVIOUS = regex.compile(r"(?r)([\p{L}\p{M}\p{N}'’\-]+)[^\p{L}\p{M}\p{N}]*")
LETTER_BEFORE = regex.compile(r"(?r)\b(\p{L})\.\s*")
CAPITAL_BEFORE = regex.compile(r"(?r)\b(\p{Lu}|EE|UU)\.\s*")
VISIBLE = regex.compile(r"\S")
UNCASED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Arabic}\p{Devanagari}\p{Thai}\p{Lao}\p{Myanmar}\p{Ethiopic}\p{Hebrew}\p{Bengali}\p{Tamil}\p{Khmer}]")
NO_BLANK_SCRIPT = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
TO_LAST_LETTER = regex.compile(r"[\p{Thai}\p{Lao}](\s+)(?=[\p{Thai}\p{Lao}])")
CODE_NAME = regex.compile(r"[a-z][\w-]*/[\w.-]+|[a-z]{1,3}[A-Z]|[a-z][\w-]*\.[a-z]{1,4}\b|`")


ENCLOSING = re.compile(r"[()\[\]（）［］“”„«»‹›「」『』【】《》〈〉〝〞〟\"]")
GREEK = regex.compile(r"\p{Greek}")
IN_ADDRESS = regex.compile(r"://|@|=|www\.")
CAPITAL_START = regex.compile(r"[\p{Lu}][\p{Ll}'’]|[\p{Lu}]\s|\p{Lu}\.\s")
CAPITAL_WORD = regex.compile(r"\p{Lu}\p{Ll}*['’]?\p{L}*(?:\s|$)")
LOW_WORD = regex.compile(r"[\p{L}\p{N}-]+(?:/[\p{L}\p{N}.-]+)?(?=\s)")
ROMAN = regex.compile(r"[IVXLC]+")
ABBREVIATING_SCRIPT = regex.compile(r"[\p{Arabic}\p{Hebrew}\p{Devanagari}]")
NUMBER_OR_LETTER = regex.compile(r"[#№]?\s?\p{N}|[A-Z]\b|[IVXLC]{2,}\b|\p{Lu}-?\p{N}")
ITEM_MARKER = regex.compile(r"\s*(?:\(?\d{1,4}[.)]|[-*+•‣◦▪·])[ \t ]+")


class Lexicon:
    """What the corpus knows of words.

    ``periods``: word -> (times with a period and going on, times with a period), ``plain``: words without
    period in running text, ``common``: words in lower case in running text, ``starters``: words in lower
    case that stand at the start of paragraphs and after question marks more often than elsewhere.
    """

    def __init__(self, periods=None, plain=None, common=None, starters=None):
        self.periods: dict[str, tuple[int, int]] = periods or {}
        self.plain: dict[str, int] = plain or {}
        self.common: frozenset[str] = frozenset(common or ())
        self.starters: frozenset[str] = frozenset(starters or ())
        self.going_on = frozenset(w for w, (on, n) in self.periods.items() if on > 2 and 2 * on > n)

    def says(self, word: str) -> bool | None:
        """Whether the corpus knows the word as an abbreviation (True), as an ordinary word (False), or not clearly."""
        on, periods = self.periods.get(word, (0, 0))
        plain = self.plain.get(word, 0) if word[:1].islower() else self.plain.get(word.lower(), 0)
        if plain > 2 and plain > periods and 10 * on < plain:
            return False
        return True if word in self.going_on and on > plain else None

    def ends_with_period(self, word: str) -> bool:
        """Whether periods behind the word hardly ever stand within a sentence."""
        on, periods = self.periods.get(word, (0, 0))
        return periods >= 20 and 10 * on < periods


def paragraphs(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the units of layout: "prose", "item", or "whole" (one sentence)."""
    lines, at = [], 0
    for m in LINE_END.finditer(text):
        lines.append((at, m.start(), m.end()))
        at = m.end()
    lines.append((at, len(text), len(text)))
    units: list[tuple[int, int, str]] = []
    kind, start, end, number = "", 0, 0, 0

    def close() -> None:
        nonlocal kind
        if kind:
            units.append((start, end, kind))
        kind = ""

    i = 0
    while i < len(lines):
        a, b, _ = lines[i]
        line = text[a:b]
        visible = line.lstrip()[:1]
        if not visible:
            close()
        elif visible.isalpha():  # no mark of layout
            if kind == "table":
                close()
            if not kind:
                kind, start = "prose", a
            end = b
        elif fence := FENCE.match(line):
            close()
            mark, j = fence.group(1), i + 1
            while j < len(lines) and not _closes(text[lines[j][0] : lines[j][1]], mark):
                j += 1
            j = min(j, len(lines) - 1)
            units.append((a, lines[j][1], "whole"))
            i = j
        elif HEADING.match(line):
            close()
            units.append((a, b, "whole"))
        elif RULE.match(line) and not BULLET.match(line):
            if kind == "prose" and line.strip()[0] in "=-" and i and text[lines[i - 1][0] : lines[i - 1][1]].strip() and start == lines[i - 1][0]:
                kind, end = "whole", b  # a heading that is underlined
                close()
            else:
                close()
                units.append((a, b, "whole"))
        elif TABLE.match(line):
            if kind != "table":
                close()
                kind, start = "table", a
            end = b
        elif (bullet := BULLET.match(line)) and (kind != "prose" or _ended(text[start:end])):
            close()
            kind, start, end, number = "item", a, b, 0
        elif not bullet and (m := NUMBERED.match(line)) and (not kind or kind == "table" or (kind == "item" and int(m.group(1)) == number + 1)):
            close()
            kind, start, end, number = "item", a, b, int(m.group(1))
        else:
            if kind == "table":
                close()
            if not kind:
                kind, start = "prose", a
            end = b
        i += 1
    close()
    return [(a, b, "whole" if kind == "table" else kind) for a, b, kind in units]


def _closes(line: str, mark: str) -> bool:
    m = FENCE.match(line)
    return bool(m) and m.group(1)[0] == mark[0] and len(m.group(1)) >= len(mark) and not line[m.end() :].strip()


def _ended(text: str) -> bool:
    return text.rstrip()[-1:] in ".!?…:;。！？।۔։။؟\"”»」）)"


def enclosed(text: str) -> list[tuple[int, int]]:
    """Outermost quotations and brackets that are opened and closed, as (place of the opener, place of the closer).

    They may be of any length. A straight quote that can only open, while another is open, shows that the other
    was never closed.
    """
    found: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    for m in ENCLOSING.finditer(text):
        c, i = m.group(), m.start()
        if c == '"':
            before, after = text[i - 1 : i], text[i + 1 : i + 2]
            apart = not before or before.isspace() or before in OPENERS
            opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if opened is not None and not (apart and (after.isalnum() or after in "¿¡")):
                found.append((stack[opened][1], i))
                del stack[opened:]
            elif opened is not None:
                del stack[opened:]
                stack.append((c, i))
            elif apart or before in "—–-.!?…:;,。，：！？" or NO_BLANK_SCRIPT.match(before):
                stack.append((c, i))
            continue
        closes = next((k for k in range(len(stack) - 1, -1, -1) if c in OPENERS.get(stack[k][0], "")), None)
        if closes is not None:
            found.append((stack[closes][1], i))
            del stack[closes:]
        elif c in OPENERS:
            stack.append((c, i))
    outer: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer


def _content_end(text: str, a: int, b: int) -> int:
    """Where what stands between text[a] and text[b] ends, without blanks and closers at its end."""
    while b > a + 1 and text[b - 1] in BEFORE_CLOSER:
        b -= 1
    return b


class Splitter:
    """Cuts the paragraphs of one document."""

    def __init__(self, text: str, lexicon: Lexicon):
        self.text, self.lexicon = text, lexicon
        self.units = paragraphs(text)
        self._going_on: Counter[str] | None = None
        self._words: PlainWords | None = None
        self._pieces: list[list[str]] | None = None
        self._known: dict[str, bool] = {}
        self._clear: dict[str, bool] = {}
        self._run, self._in_address, self._lead = (0, 0), False, 0  # of the paragraph being cut

    def pieces(self) -> list[list[str]]:
        if self._pieces is None:
            self._pieces = pieces_of(self.text, self.units)
        return self._pieces

    def own_going_on(self, word: str) -> int:
        """How often, in this document, a period stands behind the word and the sentence goes on."""
        if self._going_on is None:
            if len(self.text) < SHORT_TEXT and not self._may_go_on(word):
                return 0
            self._going_on = Counter(found for found, on in with_period(self.pieces(), self.lexicon.starters) if on)
        return self._going_on[word]

    def _may_go_on(self, word: str) -> bool:
        """Whether something that may go on a sentence stands behind any period that follows these letters."""
        mark = word + "."
        at = self.text.find(mark)
        while at >= 0:
            at += len(mark)
            first, second = self.text[at : at + 1], self.text[at + 1 : at + 2]
            if first in (",", ";") or (first.isspace() and (second.islower() or second.isspace() or second in (",", ";"))):
                return True
            at = self.text.find(mark, at)
        return False

    def own_words(self) -> PlainWords:
        if self._words is None:
            pairs: Counter[tuple[str, str]] = Counter()
            count_pairs(self.pieces(), pairs)
            self._words = PlainWords(pairs)
        return self._words

    def own_plain(self, word: str) -> int:
        """How often this document has the word without period; a capitalised one in small letters, in the midst of a sentence."""
        if self._words is None and len(self.text) < SHORT_TEXT:
            plain = word if word[:1].islower() else word.lower()
            if self.text.count(plain) == self.text.count(plain + "."):
                return 0
        words = self.own_words()
        return words.midst[word] + words.elsewhere[word] if word[:1].islower() else words.midst[word.lower()]

    def begins(self, word: str) -> bool:
        """Whether a capitalised word has its capital from the start of a sentence: an ordinary word, and not a name here."""
        low = word.lower()
        midst = self.own_words().midst
        if low in midst or low == "i":
            return True
        return word not in midst and low in self.lexicon.common

    def is_abbreviation(self, word: str) -> bool:
        """By the document, then by the corpus, then by the lists."""
        known = self._known.get(word)
        if known is None:
            known = self._known[word] = self._decide(word)
        return known

    def is_clear(self, word: str) -> bool:
        """Whether a period behind the word always ends the sentence before a capital: it is no abbreviation, number or initial."""
        known = self._clear.get(word)
        if known is None:
            low = word.lower()
            known = len(word) > 1 and word.isalpha() and low not in REFERENCES and not ROMAN.fullmatch(word) and not self.is_abbreviation(word)
            self._clear[word] = known
        return known

    def _decide(self, word: str) -> bool:
        low = word.lower()
        listed = low in CONTINUING or low in MAY_END or low.endswith("str") or (low in TITLES and word[0].isupper())
        listed = listed or (len(word) == 2 and word.isupper() and word[0] == word[1])
        on = self.own_going_on(word)
        if not listed and not on and word not in self.lexicon.going_on:
            return False
        plain = self.own_plain(word)
        if plain > on:
            return False
        corpus = self.lexicon.says(word)
        if on > 1 or (on and corpus is not False and not self.lexicon.ends_with_period(word)):  # once only may be a slip
            return True
        return listed if corpus is None else corpus

    def starts_low(self, p: str, k: int) -> bool:
        """Whether what begins at p[k] in lower case may begin a sentence: names of programs and repositories."""
        if CODE_NAME.match(p, k):
            return True
        m = WORD.match(p, k)
        return bool(m) and m.group() in self.lexicon.starters

    def run_before(self, p: str, at: int) -> str:
        """The characters of a word or an address before p[at]. Of a run that was read up to a mark in it only the rest is read."""
        blank = p.rfind(" ", max(0, at - 24), at)
        if blank >= 0 and (word := p[blank + 1 : at]).isalpha():  # the usual case
            self._in_address = False
            return word
        start, end = self._run
        lowest = end if end <= at else 0
        begin = RUN_BEFORE.match(p, lowest, at).start()
        fresh = begin
        if begin == lowest and lowest:
            begin = start
        else:
            self._in_address = False
        self._run = (begin, at)
        self._in_address = self._in_address or bool(IN_ADDRESS.search(p, max(begin, fresh - 4), at))
        return p[begin:at]

    def ends(self, p: str, at: int, stop: int, mark: str) -> bool:
        """Whether the sentence that ``mark`` closes (p[at:stop] with closers) ends there, outside of quotations."""
        k = stop + 1
        if p[stop : stop + 1] != " " or p[k : k + 1].isspace() or k >= len(p):
            visible = VISIBLE.search(p, stop)
            if not visible:
                return True
            k = visible.start()
        blank, first = k > stop, p[k]
        if mark[0] in FULL_STOPS:
            if first in ",，、;；:：" or (first in CLOSERS and first not in OPENERS):
                return False
            return not (mark[0] == "．" and first.isdigit())
        word = self.run_before(p, at).lstrip(".'’-/_&+@:=#")
        head, dot, tail = word.rpartition(".")
        if dot and tail[:1].isupper() and len(head.rpartition(".")[2]) > 2:
            word = tail  # two sentences without a blank between them
        if mark[0] in ";;":
            return bool(word) and bool(GREEK.match(word[-1])) and (blank or first in CLOSERS)
        if first in ",;:，、；：" or (first in "-–—" and first != "-" and mark != "."):
            return False
        if not blank:
            return self.ends_without_blank(p, at, mark, word, k)
        if mark != "." or not word:
            return (mark != "." or at > self._lead) and (not first.islower() or self.starts_low(p, k))
        return self.period_ends(p, at, word, k)

    def ends_without_blank(self, p: str, at: int, mark: str, word: str, k: int) -> bool:
        first, last = p[k], p[at - 1 : at]
        if NO_BLANK_SCRIPT.match(first) and mark != ".":
            return True
        if self._in_address:
            return False
        if UNCASED.match(last) and (UNCASED.match(first) or CODE_NAME.match(p, k)):
            return True
        if "…" in mark or len(mark) > 1:
            return first.isupper()
        if first.isupper() and (CAPITAL_START.match(p, k) or UNCASED.match(last)):
            if "/" in word or not (last.isalpha() or last.isdigit() or last in CLOSERS or last in "%€$°"):
                return False
            tail = word.rpartition(".")[2]
            if last.isdigit():
                return bool(CAPITAL_WORD.match(p, k))
            return len(tail) > 2 or word.lower() in MAY_END
        if mark != ".":
            return first in QUOTES or first.isupper() or first in "¿¡("
        return bool(UNCASED.match(first)) and len(word) > 2 or first in "¿¡«„“" or (last.isalpha() and len(word) > 3 and "." not in word and self.low_start_attached(p, k))

    def low_start_attached(self, p: str, k: int) -> bool:
        m = LOW_WORD.match(p, k)
        return bool(m) and (m.group() in self.lexicon.starters or "/" in m.group())

    def period_ends(self, p: str, at: int, word: str, k: int) -> bool:
        first = p[k]
        low = word.lower()
        if first.isupper() and self.is_clear(word):
            return True
        m = FOLLOWING.match(p, k)
        following = m.group(1) if m else ""
        if word.isdigit() or ROMAN.fullmatch(word):
            before = PREVIOUS.match(p, 0, at - len(word)) if word.isdigit() and len(word) < 4 else None
            previous = before.group(1).lower() if before else ""
            if previous in BEFORE_ORDINAL and first.isalpha():
                return following.lower() in BEFORE_ORDINAL and self.begins(following) and previous not in ("dem", "zum", "am", "vom", "seit")
            if word.isdigit():
                return not first.islower() or self.starts_low(p, k)
        if len(word) == 1 and word.isalpha():
            if UNCASED.match(word):
                return not ABBREVIATING_SCRIPT.match(word)
            if word.islower() and low not in MAY_END:
                pair = LETTER_BEFORE.match(p, 0, at - 1)
                if pair and f"{pair.group(1).lower()}.{low}" in MAY_END:
                    return first.isupper() and self.begins(following)
                return False
            if word.isupper():
                if first.islower() or first.isdigit():
                    return False
                pair = CAPITAL_BEFORE.match(p, 0, at - 1)
                return bool(pair) and f"{pair.group(1).lower()}.{low}" in MAY_END and self.begins(following)
        if low in REFERENCES and NUMBER_OR_LETTER.match(p, k) and following not in ("A", "I"):
            return False
        if self.is_abbreviation(word):
            if low in MAY_END:
                if first.isupper() or first in "\"“„«‹¿¡(":
                    return self.begins(following) if low in BEFORE_NAMES and first.isupper() else True
                if first.isdigit():
                    return low in ("inc", "ltd", "corp", "llc", "p.m", "a.m", "gmbh")
                if first.islower():
                    return self.starts_low(p, k)
                return bool(UNCASED.match(first)) or not first.isalnum() and first not in "$€£%&-–—"
            if low in CONTINUING or low in TITLES or low.endswith("str"):
                return False
            if len(word) == 2 and word.isupper() and word[0] == word[1]:  # plurals of initials, as in "EE. UU."
                return first.isupper() and self.begins(following)
            # A learned one: what follows with a capital starts a sentence only if it is a common word.
            return first.isupper() and self.begins(following) or (not first.isalnum() and first not in "$€£%&-–—(")
        if first.islower():
            return self.starts_low(p, k) or self.own_plain(word) > 0 or word in self.lexicon.plain
        return True

    def goes_on(self, p: str, sentence: int, a: int, stop: int, opens: set[int]) -> bool:
        """Whether the sentence goes on after the quotation or bracket, opened at p[a], that holds a terminator at its end."""
        visible = VISIBLE.search(p, stop)
        if not visible or visible.start() in opens:
            return False
        k = visible.start()
        first = p[k]
        if first in ",;:，、；：。.!?！？…।۔؟" or first in CLOSERS:
            return True
        before = VISIBLE.search(p, sentence)
        introduced = before.start() < a
        if p[a] not in QUOTES:
            return introduced and not first.isupper() and not (first in QUOTES or first in OPENERS or first in "¿¡")
        if first in "—–-":
            return True
        if NO_BLANK_SCRIPT.match(first) or first in "と":
            return bool(KANA_QUOTE.match(p, k) or not introduced and HAN_SPEECH.match(p, k))
        if HANGUL_QUOTE.match(p, k):
            return True
        if UNCASED.match(first):
            return introduced and bool(AND_THEN.match(p, k))
        if first.islower():
            return not self.starts_low(p, k)
        return p[a + 1 : stop].rstrip("\"'”»“ \u00a0\u202f")[-1:] in ("?", "!") and bool(SPEECH_AFTER_NAME.match(p, k))

    def prose(self, start: int, end: int, item: bool) -> list[tuple[int, int]]:
        p = self.text[start:end]
        if not item and not _ended(p) and not LINE_END.search(p.strip()) and _is_title(p):
            return trimmed(self.text, start, (0, len(p)))
        skip = 0
        if item:
            m = ITEM_MARKER.match(p)
            skip = m.end() if m else 0
        visible_end = len(p.rstrip())
        m = TERMINATOR.search(p, skip)
        if (not m or m.end() >= visible_end) and (p.isascii() or not TO_LAST_LETTER.search(p, skip)):
            return trimmed(self.text, start, (0, len(p)))
        self._run, self._in_address = (0, 0), False
        self._lead = VISIBLE.search(p).start()
        inside = enclosed(p)
        opens = {a for a, _ in inside}
        tails = [_content_end(p, a, b) for a, b in inside]
        k, sentence = 0, 0
        cuts: list[int] = []
        at = skip
        while m := TERMINATOR.search(p, at):
            i, j = m.span()
            at = j
            if j >= visible_end:
                break
            if p[j].isdigit() and p[i] == "." and i and p[i - 1].isdigit():
                continue  # a decimal or the like
            if j == i + 1 and (k >= len(inside) or j <= inside[k][0]) and p[i] == "." and p[j : j + 1] == " " and p[j + 1 : j + 2].isupper():
                blank = p.rfind(" ", max(0, i - 24), i)  # the usual case: a small word, a blank and a capital
                if blank >= 0 and self.is_clear(p[blank + 1 : i]):
                    cuts.append(j)
                    sentence = j
                    continue
            while k < len(inside) and inside[k][1] < i:
                k += 1
            if k < len(inside) and inside[k][0] < i < inside[k][1]:
                a, b = inside[k]
                if m.group() in ";;" and not GREEK.match(p[i - 1 : i]):
                    continue
                if j < tails[k]:
                    continue
                if p[a] in "([（［【" and self.abbreviation_at(p, i, m.group()):
                    continue
                stop = b + 1
                while stop < len(p) and p[stop] in CLOSERS and p[stop] not in "'\"" and stop not in opens:
                    stop += 1
                at = stop
                if not self.goes_on(p, sentence, a, stop, opens):
                    cuts.append(stop)
                    sentence = stop
                continue
            stop = j
            while stop < len(p) and p[stop] in CLOSERS and stop not in opens:
                stop += 1
            if self.ends(p, i, stop, m.group()):
                cuts.append(stop)
                sentence = stop
            at = max(at, stop)
        for blank in () if p.isascii() else TO_LAST_LETTER.finditer(p, skip):
            i = blank.start(1)
            if not any(a < i < b for a, b in inside):
                cuts.append(i)
        return trimmed(self.text, start, (0, *sorted(set(cuts)), len(p)))

    def abbreviation_at(self, p: str, at: int, mark: str) -> bool:
        word = self.run_before(p, at).lstrip(".'’-/_&+@:=#")
        return mark == "." and bool(word) and self.is_abbreviation(word)

    def sentences(self) -> list[tuple[int, int]]:
        found = []
        for start, end, kind in self.units:
            found += trimmed(self.text, start, (0, end - start)) if kind == "whole" else self.prose(start, end, kind == "item")
        return found


def _is_title(line: str) -> bool:
    """A line without a terminator at its end whose words have capitals, or that names a chapter."""
    if CHAPTER.match(line):
        return True
    words = [w for w in WORD.findall(line) if len(w) > 3 and w[0].isalpha()]
    return 0 < len(words) <= 10 and all(w[0].isupper() for w in words)


def trimmed(text: str, start: int, cuts: tuple[int, ...]) -> list[tuple[int, int]]:
    """The pieces between the cuts, counted from ``start``, without white space at either end; those of nothing else are left out."""
    spans = []
    for a, b in zip(cuts, cuts[1:]):
        a, b = start + a, start + b
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            spans.append((a, b))
    return spans


# A word as it is counted, with an opener before it and at most one mark, or a period and a mark, behind it.
COUNTED = regex.compile(r"[(\"“«„]?([\p{L}\p{M}]+(?:['’\-.][\p{L}\p{M}]+)*+)(?:([.,;:]?)|(\.[,;]))")
#: Entries of the table of what is known of the pieces between blanks; it is emptied when full.
PIECES = 500_000
_pieces: dict[str, tuple[str, str]] = {}


def _piece(piece: str) -> tuple[str, str]:
    """(word, mark) of what stands between two blanks; the word is "" where it isn't one word."""
    known = _pieces.get(piece)
    if known is None:
        m = COUNTED.fullmatch(piece)
        known = (m.group(1), m.group(3) or m.group(2)) if m else ("", "")
        if len(_pieces) >= PIECES:
            _pieces.clear()
        if len(piece) <= 64:
            _pieces[piece] = known
    return known


def pieces_of(text: str, units: Iterable[tuple[int, int, str]]) -> list[list[str]]:
    """What stands between blanks, per unit of prose."""
    return [text[a:b].split() for a, b, kind in units if kind != "whole"]


def with_period(units: list[list[str]], starters: frozenset[str] = frozenset()) -> Iterator[tuple[str, bool]]:
    """(word, whether the sentence goes on) of words with a period, but for the first of each unit."""
    for pieces in units:
        for piece, then in [(x, y) for x, y in zip(pieces[1:], [*pieces[2:], ""]) if "." in x]:
            if piece[-1] == "." or piece[-2:-1] == ".":
                word, mark = _piece(piece)
                if word and mark == ".":
                    yield word, bool(then) and (then[0].islower() or then[0] in ",;") and not CODE_NAME.match(then) and then not in starters
                elif word and len(mark) == 2:
                    yield word, True


def count_pairs(units: list[list[str]], pairs: Counter[tuple[str, str]]) -> None:
    """Adds the pieces with the last character of the piece before; the first of a unit stands behind a "?"."""
    for pieces in units:
        pairs.update(zip(["?", *[x[-1] for x in pieces]], pieces))


class PlainWords:
    """Words without period: ``midst``, in the midst of a sentence; ``elsewhere``, behind other marks, quotes and brackets;
    ``starting``, in lower case where a sentence starts, at the head of a unit or behind a question or exclamation mark."""

    def __init__(self, pairs: Counter[tuple[str, str]]):
        self.midst: Counter[str] = Counter()
        self.elsewhere: Counter[str] = Counter()
        self.starting: Counter[str] = Counter()
        for (behind, piece), n in pairs.items():
            word, mark = _piece(piece)
            if not word:
                continue
            if behind in "?!":
                if piece[0].islower():
                    self.starting[word] += n
            elif mark[:1] != ".":
                (self.midst if (behind.isalnum() or behind in ",;") and piece[0] == word[0] else self.elsewhere)[word] += n


def roles(texts: Iterable[str]) -> Counter[tuple[str, str]]:
    """(word, role) of what stands unambiguously: "on" and "end" (a period follows, and the sentence goes on or
    may end), "plain" (none follows), "common" (in lower case in the midst of a sentence), "start" (in lower case
    where one starts)."""
    pairs: Counter[tuple[str, str]] = Counter()
    counts: Counter[tuple[str, str]] = Counter()
    for text in texts:
        units = pieces_of(text, paragraphs(text))
        counts.update((word, "on" if on else "end") for word, on in with_period(units))
        count_pairs(units, pairs)
    words = PlainWords(pairs)
    for word, n in (words.midst + words.elsewhere).items():
        counts[word, "plain"] += n
    for word, n in words.midst.items():
        if word[0].islower():
            counts[word, "common"] += n
    for word, n in words.starting.items():
        counts[word, "start"] += n
    return counts


def count_roles(df: DataFrame, text: str) -> DataFrame:
    """Words of all texts with the number of times they have each role."""

    def written(texts: list[str]) -> pa.RecordBatch:
        counts = roles(texts)
        columns = [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "role", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                content = value.as_py()
                if content:
                    held.append(content)
                    size += len(content)
                if size >= COUNTED_CHARS:
                    yield written(held)
                    held, size = [], 0
        if held:
            yield written(held)

    counted = spread(pick(df, text=text)).mapInArrow(count, "word string, role string, n long")
    return counted.groupBy("word", "role").agg(F.sum("n").alias("n"))


def learn_lexicon(df: DataFrame, *, text: str, least_share: float = LEAST_SHARE) -> Lexicon:
    """The lexicon of a corpus. At most 1 / least_share words of each role can reach the driver, whatever its size."""
    counts = cut_lineage(count_roles(df, text).groupBy("word").pivot("role", ["on", "end", "plain", "common", "start"]).sum("n").na.fill(0))
    total = counts.agg(F.sum(F.col("on") + F.col("end") + F.col("plain") + F.col("start"))).first()[0] or 0
    floor = least_share * total
    kept = counts.filter(((F.col("on") + F.col("end")) > floor) | (F.col("plain") > floor) | (F.col("common") > floor) | (F.col("start") > floor))
    lexicon = Lexicon()
    common, starters = set(), set()
    for row in kept.collect():
        word = row["word"]
        if row["on"] + row["end"] > floor:
            lexicon.periods[word] = (row["on"], row["on"] + row["end"])
        if row["plain"] > floor:
            lexicon.plain[word] = row["plain"]
        if row["common"] > floor:
            common.add(word)
        if row["start"] > floor and row["start"] > row["common"]:
            starters.add(word)
    lexicon.common, lexicon.starters = frozenset(common), frozenset(starters)
    return lexicon


def split_sentences(df: DataFrame, *, key: str, text: str, lexicon: Lexicon | None = None) -> DataFrame:
    """The sentences of every text: key, start_char, end_char, counted in Unicode code points from 0, end exclusive.

    The sentences of a text cover all of its characters but white space, in order and without overlap, and
    have no white space at either end. Null, empty and blank texts have none; keys, also null or repeated
    ones, are passed through. Texts are read whole, whatever their length. An empty table gives no rows. Of
    further columns nothing is read.

    Runs a job that learns the lexicon from all texts, unless one is given.
    """
    lexicon = lexicon or learn_lexicon(df, text=text)
    held = df.sparkSession.sparkContext.broadcast(pickle.dumps(lexicon))
    rows = spread(pick(df, key=key, text=text))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(held.value)  # noqa: S301 - our own bytes
        for batch in batches:
            which, starts, ends = [], [], []

            def written() -> pa.RecordBatch:
                keys = batch.column(0).take(pa.array(which, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["key", "start_char", "end_char"])  # noqa: B023

            for i, value in enumerate(batch.column(1)):
                content = value.as_py()
                if content and not content.isspace():
                    spans = Splitter(content, known).sentences()
                    which += [i] * len(spans)
                    starts += [a for a, _ in spans]
                    ends += [b for _, b in spans]
                if len(which) >= 1 << 18:
                    yield written()
                    which, starts, ends = [], [], []
            yield written()

    return rows.mapInArrow(split, f"key {rows.schema['key'].dataType.simpleString()}, start_char long, end_char long")
