"""Per-document text quality statistics, and which documents are lists, tables or junk.

A text is cut into chunks, which are rows of their own.  A chunk gives partial counts of the
lines it holds whole and the state of its two edges: the piece of a line, of a word and of a
run of lines that goes on beyond them.  Merging two neighbours joins the edge pieces, and what
they close is counted then, so any bracketing gives the counts of the whole text: chunks merge
in a tree.  Ratios and rules are derived from the merged counts.

The state is bounded.  A line of up to LINE characters is judged by its text, which the edge
keeps; a longer line is judged by counts that add up, with its open words at both ends.  In
such a line a run of more than TOKEN characters without white space is one odd word.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.mail import own_writing
from panelwright.session import cut

CHUNK_CHARS = 32_768
#: Chunks merged at once by one step of the tree.
FAN_IN = 16
#: Lines up to this length are judged by their text, longer ones by counts; likewise runs without white space.
LINE, TOKEN = 4_096, 256

COUNTS = ["chars", "words", "letters", "symbols", "digits", "lines", "ended_lines", "common_words", "repeats", "prose_chars", "list_chars", "table_chars", "junk_chars"]
_AT = {name: i for i, name in enumerate(COUNTS)}

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_END = (".", "!", "?", "…", ".”", '."', "!)", ".)", "?)")
_ITEM = re.compile(r"\s*(?:[-*•–—+☐☑☒✓◦▪·]|\[[ xX✓]?\]|TODO|DONE|\(?(?:\d{1,4}|[A-Za-z]|[ivxIVX]{1,5})[.)]|\d{1,4} [-–])\s+\S")
_ADDRESS = re.compile(r"(?:<?[^\s@<>]+@[^\s@<>]+\.[^\s@<>]+>?[,;]?|(?:https?|ftp)://\S+|www\.\S+)$", re.I)
_SETTING = re.compile(r"[^\W\d_][\w .-]{0,24}\s*[:=]\s*\S")
_NAME = re.compile(r"[^\W\d_a-zß-öø-ÿ][\w'’.-]*(?: [^\W\d_a-zß-öø-ÿ][\w'’.-]*){0,3},?$")
_RULE = re.compile(r"[+|]?[-=+|: ]{3,}[+|]$|[-=+|:]{3,}$")
_CSV = re.compile(r'"?[^",;\s][^",;]*"?([,;])(?:"?[^",;]*"?\1)+"?[^",;]*"?$')
_QUOTED = re.compile(r'"[^"]*"(?:[;,\t]"[^"]*")+$')
_GAP = re.compile(r" {2,}")
_HEX = re.compile(r"(?:0x[0-9a-f]{4,}\b.*|(?:[0-9a-f]{2}[ :]){5,}[0-9a-f]{0,2})$", re.I)
_CLUSTER = re.compile(r"[bcdfgjklmnpqrtvwxz]{5}|(.)\1\1", re.I)
_VOWEL = re.compile(r"[aeiouyáéíóúäöüàèìòùâêîôûëïœæå]", re.I)


def odd_word(w: str) -> bool:
    """A run of letters that is no word of a European language: wild case, no vowel, hard clusters, too long."""
    n = len(w)
    if n > 24 or _CLUSTER.search(w):
        return True
    if n >= 4 and not _VOWEL.search(w):
        return True
    inner = w[1:]
    return n >= 3 and not w.isupper() and not inner.islower() and "-" not in w and "'" not in w and "’" not in w and inner.lower() != inner and not (w[0].isupper() and inner[1:2].isupper() and n < 5)


_BLANK, _DIGIT, _NOT_ALNUM = b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f", b"0123456789", bytes(i for i in range(128) if not chr(i).isalnum())


def _char_counts(s: str) -> tuple[int, int, int]:
    """(characters that are no white space, digits, letters and digits) of a text."""
    if s.isascii():
        b = s.encode("ascii")
        n = len(b)
        return len(b.translate(None, _BLANK)), n - len(b.translate(None, _DIGIT)), len(b.translate(None, _NOT_ALNUM))
    return len("".join(s.split())), sum(map(str.isdigit, s)), sum(map(str.isalnum, s))


class Words:
    """Words as they are counted: folded case, whether frequent, whether odd; kept for words seen before."""

    def __init__(self, common: frozenset[str]) -> None:
        self.common = frozenset(w.casefold() for w in common)
        self.seen: dict[str, tuple[str, bool, bool]] = {}

    def __call__(self, w: str) -> tuple[str, bool, bool]:
        told = self.seen.get(w)
        if told is None:
            fold = w.casefold()
            told = (fold, fold in self.common, odd_word(w))
            if len(self.seen) < 200_000:
                self.seen[w] = told
        return told


# A section is what a stretch of words adds up to: [solid, letters, digits, alnum, semicolons, words, common, odd,
# repeats, first word, last word]; an end word that is no word in folded case (too long) is None.
_NOTHING = [0, 0, 0, 0, 0, 0, 0, 0, 0, None, None]


def _section(text: str, words: Words) -> list:
    found = _WORD.findall(text)
    told = [words(w) for w in found]
    folds = [t[0] for t in told]
    solid, digits, alnum = _char_counts(text)
    return [
        solid, sum(map(len, found)), digits, alnum, text.count(";"), len(found), sum(t[1] for t in told), sum(t[2] for t in told),
        sum(map(str.__eq__, folds, folds[1:])), folds[0] if folds else None, folds[-1] if folds else None,
    ]


def _add(a: list, b: list) -> list:
    if not b[0]:
        return a
    if not a[0]:
        return b
    out = [x + y for x, y in zip(a[:9], b[:9])]
    out[8] += a[5] > 0 and b[5] > 0 and a[10] is not None and a[10] == b[9]
    return [*out, a[9] if a[5] else b[9], b[10] if b[5] else a[10]]


# A piece of a run without white space: [length, letters, digits, alnum, semicolons, text or None if longer than TOKEN].
def _piece(text: str) -> list:
    _, digits, alnum = _char_counts(text)
    return [len(text), sum(map(str.isalpha, text)), digits, alnum, text.count(";"), text if len(text) <= TOKEN else None]


def _glue(a: list, b: list) -> list:
    n = a[0] + b[0]
    return [n, a[1] + b[1], a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] + b[5] if n <= TOKEN else None]


def _closed(piece: list, words: Words) -> list:
    if piece[5] is not None:
        return _section(piece[5], words)
    word = int(piece[1] > 0)
    return [piece[0], piece[1], piece[2], piece[3], piece[4], word, 0, word, 0, None, None]


# Counts of a stretch of a long line: [first piece, section between, last piece or None if there is one piece only, last two characters].
def _stretch(core: str, words: Words) -> list:
    runs = core.split()
    if len(runs) == 1:
        return [_piece(core), _NOTHING, None, core[-2:]]
    mid = _NOTHING
    for run in runs[1:-1]:
        mid = _add(mid, _closed(_piece(run), words))
    return [_piece(runs[0]), mid, _piece(runs[-1]), core[-2:]]


def _joined(a: list, gap: bool, b: list, words: Words) -> list:
    end = (a[3] + (" " if gap else "") + b[3])[-2:]
    if gap:
        left = a[1] if a[2] is None else _add(a[1], _closed(a[2], words))
        right = b[1] if b[2] is None else _add(_closed(b[0], words), b[1])
        return [a[0], _add(left, right), b[0] if b[2] is None else b[2], end]
    if a[2] is None:
        return [_glue(a[0], b[0]), b[1], b[2], end]
    if b[2] is None:
        return [a[0], a[1], _glue(a[2], b[0]), end]
    return [a[0], _add(_add(a[1], _closed(_glue(a[2], b[0]), words)), b[1]), b[2], end]


# A piece of a line: [white space before, text or None if longer than LINE, its length, white space after, counts if longer than LINE].
# White space is kept as text up to LINE characters, then as its length.
def _fragment(text: str, words: Words) -> list:
    core = text.strip()
    if not core:
        return [_white(text), "", 0, "", None]
    at = len(text) - len(text.lstrip())
    n = len(core)
    return [_white(text[:at]), core if n <= LINE else None, n, _white(text[at + n :]), None if n <= LINE else _stretch(core, words)]


def _white(text: str) -> str | int:
    return text if len(text) <= LINE else len(text)


def _whites(a: str | int, b: str | int) -> str | int:
    if isinstance(a, str) and isinstance(b, str):
        return _white(a + b)
    return (len(a) if isinstance(a, str) else a) + (len(b) if isinstance(b, str) else b)


def _continued(a: list, b: list, words: Words) -> list:
    """The piece of a line that two neighbouring pieces make."""
    if not a[2]:
        return [_whites(a[0], b[0]), *b[1:]]
    if not b[2]:
        return [*a[:3], _whites(a[3], b[0]), a[4]]
    gap = _whites(a[3], b[0])
    n = a[2] + b[2] + (len(gap) if isinstance(gap, str) else gap)
    if n <= LINE:
        return [a[0], a[1] + gap + b[1], n, b[3], None]
    left, right = (x[4] if x[4] is not None else _stretch(x[1], words) for x in (a, b))
    return [a[0], None, n, b[3], _joined(left, gap not in ("", 0), right, words)]


# Lines: [counts, words section ends (number, first, last), number of lines with a kind, kinds of the first two, of the last two].
# Counts hold the kinds of inner lines only: what an outer line is may depend on the line beyond it.
def _empty() -> list:
    return [[0] * len(COUNTS), [0, None, None], 0, [], []]


def _settled(v: list, before: list, line: list, after: list) -> None:
    kind = line[0]
    if kind == "list" and before[0] == after[0] == "table":
        kind = "table"  # a short row among rows of cells
    if kind:
        v[_AT[f"{kind}_chars"]] += line[1]


def _after(a: list, b: list) -> list:
    """Lines ``a`` followed by lines ``b``."""
    if not a[2]:
        return b
    if not b[2]:
        return a
    v = [x + y for x, y in zip(a[0], b[0])]
    wa, wb = a[1], b[1]
    v[8] += wa[0] > 0 and wb[0] > 0 and wa[2] is not None and wa[2] == wb[1]
    ends = [wa[0] + wb[0], wa[1] if wa[0] else wb[1], wb[2] if wb[0] else wa[2]]
    if a[2] > 1:
        _settled(v, a[4][0], a[4][-1], b[3][0])
    if b[2] > 1:
        _settled(v, a[4][-1], b[3][0], b[3][1])
    return [v, ends, a[2] + b[2], (a[3] + b[3])[:2], (a[4] + b[4])[-2:]]


def _line(fragment: list, words: Words) -> list:
    """Counts of a line that is whole."""
    text, n = fragment[1], fragment[2]
    if not n:
        return _empty()
    if text is not None:
        m = _section(text, words)
        kind, ended = line_kind(text, m), text.endswith(_END)
    else:
        first, mid, last, end = fragment[4]
        m = _add(_closed(first, words), mid)
        m = m if last is None else _add(m, _closed(last, words))
        kind, ended = long_line_kind(m, last is not None, end), end.endswith(_END)
    v = [m[0], m[5], m[1], m[0] - m[3], m[2], 1, int(ended), m[6], m[8], 0, 0, 0, 0]
    told = [kind, m[0]]
    return [v, [m[5], m[9], m[10]], 1, [told], [told]]


def line_kind(s: str, m: list) -> str:
    """prose, list, table, junk, or '' for an introducing line, of a line without outer blanks and its section."""
    n = len(s)
    solid, letters, digits, nw, common, odd = m[0], m[1], m[2], m[5], m[6], m[7]
    if _RULE.match(s):
        return "table" if ("+" in s or "|" in s) and len(set(s)) > 1 else "junk"
    if _HEX.match(s):
        return "junk"
    pipes = s.count("|")
    if s[0] == "|" and s[-1] == "|" and pipes >= 3 and letters + digits > 0.4 * (solid - pipes):
        return "table"
    if "\t" in s:
        cells = [c for c in s.split("\t") if c.strip()]
        if len(cells) >= 2 and sum(len(c.split()) for c in cells) <= 4 * len(cells):
            return "table"
    if s[0] == '"' and _QUOTED.match(s):
        return "table"
    if "  " in s:
        gaps = _GAP.split(s)
        if len(gaps) >= 3 and len(s.split()) <= 2.5 * len(gaps) and letters + digits > 0.4 * solid:
            return "table"
    if "," in s or ";" in s:
        c = _CSV.match(s)
        if c and s.count(c.group(1) + " ") == 0 and s.count(" ") <= s.count(c.group(1)) and letters + digits > 0.4 * solid:
            return "table"
    if _ADDRESS.match(s):
        return "list"
    share = common / nw if nw else 0.0
    if _ITEM.match(s) and letters > 0.4 * solid and n < 400 and not (nw >= 6 and share >= 0.35):
        return "list"
    setting = n < 80 and _SETTING.match(s) is not None
    if letters < 0.5 * solid and not setting:
        return "junk" if solid > 3 and digits < 0.6 * solid else ("list" if nw <= 2 else "prose")
    if nw and odd > 0.3 * nw and (n > 12 or odd == nw):
        return "junk"
    if n > 40 and " " not in s:
        return "junk"
    if s[-1] == ":" and nw <= 8:
        return ""
    ended = s.endswith(_END)
    if setting and nw < 8 and not ended and share < 0.4:
        return "list"
    marks = m[4]
    if marks >= 2 and nw <= 5 * (marks + 1) and share < 0.6:
        return "list"
    if marks and share < 0.4 and nw <= 8 * (marks + 1) and not (marks == 1 and s[-1] == "."):
        return "list"
    if nw <= 4 and n < 60 and _NAME.match(s):
        return "list"
    if ended or s[-1] in ",;":
        return "prose"
    if nw >= 5 and share == 0.0:
        return "junk" if odd > 0.15 * nw else "list"
    return "list" if nw <= 4 and share < 0.25 and n < 40 else "prose"


def long_line_kind(m: list, spaced: bool, end: str) -> str:
    """Kind of a line longer than LINE from counts alone."""
    solid, letters, digits, marks, nw, common, odd = m[0], m[1], m[2], m[4], m[5], m[6], m[7]
    share = common / nw if nw else 0.0
    if letters < 0.5 * solid:
        return "junk" if digits < 0.6 * solid else "table"
    if not spaced or odd > 0.3 * nw:
        return "junk"
    if marks >= 2 and nw <= 5 * (marks + 1) and share < 0.6 or marks and share < 0.4 and nw <= 8 * (marks + 1):
        return "list"
    if end.endswith(_END) or end[-1] in ",;":
        return "prose"
    return ("junk" if odd > 0.15 * nw else "list") if share == 0.0 else "prose"


def partial(chunk: str, words: Words) -> list:
    """State of a chunk: [piece of its first line, whole lines, piece of its last line or None if it holds no line end]."""
    lines = chunk.split("\n")
    if len(lines) == 1:
        return [_fragment(chunk, words), _empty(), None]
    return [_fragment(lines[0], words), _lines(lines[1:-1], words), _fragment(lines[-1], words)]


def _lines(lines: list[str], words: Words) -> list:
    """Counts of lines that are whole, in order; the same as adding them one by one, in one pass."""
    v = [0] * len(COUNTS)
    told: list[list] = []
    count, first, last = 0, None, None
    for text in lines:
        if not text or text.isspace():
            continue
        w, ends, _, kinds, _ = _line(_fragment(text, words), words)
        for i, x in enumerate(w):
            v[i] += x
        if ends[0]:
            v[8] += count > 0 and last is not None and last == ends[1]
            first, last = (first if count else ends[1]), ends[2]
            count += ends[0]
        told.append(kinds[0])
    for i in range(1, len(told) - 1):
        _settled(v, told[i - 1], told[i], told[i + 1])
    return [v, [count, first, last], len(told), told[:2], told[-2:]]


def merge(a: list, b: list, words: Words) -> list:
    """State of two neighbouring stretches of a text; a line or word that went through the cut is whole again."""
    if a[2] is None:
        return [_continued(a[0], b[0], words), b[1], b[2]]
    if b[2] is None:
        return [a[0], a[1], _continued(a[2], b[0], words)]
    between = _line(_continued(a[2], b[0], words), words)
    return [a[0], _after(_after(a[1], between), b[1]), b[2]]


def finish(state: list, words: Words) -> list[int]:
    """Counts of a whole text from its state."""
    lines = _after(_line(state[0], words), state[1])
    if state[2] is not None:
        lines = _after(lines, _line(state[2], words))
    v = list(lines[0])
    outer = [] if not lines[2] else lines[3][:1] if lines[2] == 1 else [lines[3][0], lines[4][-1]]
    for kind, solid in outer:
        if kind:
            v[_AT[f"{kind}_chars"]] += solid
    return v


def chunks(text: str, size: int = CHUNK_CHARS) -> list[str]:
    """Pieces of at most ``size`` characters that together are the text, cut after a line end or blank where there is one."""
    out, at, n = [], 0, len(text)
    while at < n or not out:
        end = min(n, at + size)
        if end < n:
            line = text.rfind("\n", at + size // 2, end)
            blank = max(text.rfind(" ", at + size // 2, end), text.rfind("\t", at + size // 2, end))
            end = line + 1 if line >= 0 else blank + 1 if blank >= 0 else end
        out.append(text[at:end])
        at = end
    return out


SCHEMA_TAIL = "row bigint, chunk int, n_chunks int"


def pieces(documents: DataFrame, common: frozenset[str], key: str = "doc_id", text: str = "text", own: bool = True, size: int = CHUNK_CHARS) -> DataFrame:
    """Chunks of every text (of the sender's own writing with ``own``), a row each, written once.

    A text of one chunk is counted at once (``counts``); chunks of longer texts are kept as
    ``part`` to be counted wherever they are sent.  ``row`` tells the texts apart, as keys may
    be null or repeat.  Keys travel as text, since a batch with null keys would turn long
    numbers into inexact ones.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(common)
        for frame in frames:
            rows = []
            for k, t, n in zip(frame.iloc[:, 0], frame.iloc[:, 1], frame.iloc[:, 2]):
                t = (own_writing(t) if own else t) if isinstance(t, str) else ""
                if len(t) <= size:
                    rows.append((k, n, 0, 1, finish(partial(t, words), words), None))
                else:
                    cuts = chunks(t, size)
                    rows += [(k, n, i, len(cuts), None, c) for i, c in enumerate(cuts)]
            yield pd.DataFrame(rows, columns=["key", "row", "chunk", "n_chunks", "counts", "part"])

    sent = documents.select(F.col(key).cast("string").alias("key"), text, F.monotonically_increasing_id().alias("row"))
    out = sent.mapInPandas(run, f"key string, {SCHEMA_TAIL}, counts array<bigint>, part string")
    return cut(out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key))


def merged(told: DataFrame, common: frozenset[str], key: str = "doc_id") -> DataFrame:
    """One row per text with its counts, from a table of :func:`pieces`.

    Chunks of longer texts are dealt out one by one, whichever text they are of, and their
    states merge FAN_IN at a time, level by level.  Texts of one chunk take no part in any
    shuffle.
    """
    done = told.where("n_chunks = 1").select(key, "counts")
    many = told.where("n_chunks > 1")
    most = many.agg(F.max("n_chunks").alias("m")).collect()[0]["m"] or 1
    if most == 1:
        return done
    kind = told.schema[key].dataType.simpleString()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(common)
        for frame in frames:
            frame["state"] = [json.dumps(partial(p, words)) for p in frame.pop("part")]
            yield frame

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        words = Words(common)
        acc = None
        for text in frame["state"]:
            state = json.loads(text)
            acc = state if acc is None else merge(acc, state, words)
        row = frame.iloc[0]
        return pd.DataFrame([(row["key"], int(row["row"]), int(row["up"]), int(-(-row["n_chunks"] // FAN_IN)), json.dumps(acc))], columns=["key", "row", "chunk", "n_chunks", "state"])

    def close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(common)
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "counts": [finish(json.loads(s), words) for s in frame["state"]]})

    sent = many.select(F.col(key).cast("string").alias("key"), "row", "chunk", "n_chunks", "part").repartition("row", "chunk")
    level = sent.mapInPandas(count, f"key string, {SCHEMA_TAIL}, state string")
    while most > 1:
        grouped = level.withColumn("up", (F.col("chunk") / FAN_IN).cast("int"))
        level = grouped.groupBy("row", "up").applyInPandas(join, f"key string, {SCHEMA_TAIL}, state string")
        most = -(-most // FAN_IN)
    whole = level.select("key", "state").mapInPandas(close, "key string, counts array<bigint>")
    return done.unionByName(whole.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key))


#: Share of own writing from which a text is mainly prose, and share of repeated words of filler.
PROSE, REPEATED = 0.5, 0.3
#: Prose of any length has frequent words; text of WORDS words or more with a smaller share is noise.
WORDS, FREQUENT = 6, 0.12


def statistics(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ratios and the kind of each text from its merged counts; ratios of nothing are null."""

    def n(name: str) -> Column:
        return F.col("counts")[_AT[name]]

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b)

    weighed = n("prose_chars") + n("list_chars") + n("table_chars") + n("junk_chars")
    noise = (n("words") >= WORDS) & (n("common_words") < FREQUENT * n("words"))
    prose = F.when(noise, 0.0).otherwise(n("prose_chars"))
    junk = n("junk_chars") + n("prose_chars") - prose
    best = F.greatest(n("list_chars"), n("table_chars"), junk)
    filler = (n("words") >= 8) & (n("repeats") >= REPEATED * n("words"))
    kind = (
        F.when(weighed == 0, F.lit(None).cast("string"))
        .when(filler, "junk")
        .when(prose >= PROSE * weighed, "prose")
        .when(n("table_chars") == best, "table")
        .when(n("list_chars") == best, "list")
        .otherwise("junk")
    )
    return counts.select(
        key,
        n("chars").alias("n_chars"),
        n("words").alias("n_words"),
        n("lines").alias("n_lines"),
        ratio(n("letters"), n("words")).alias("mean_word_length"),
        ratio(n("symbols"), n("chars")).alias("symbol_ratio"),
        ratio(n("digits"), n("chars")).alias("digit_ratio"),
        ratio(n("ended_lines"), n("lines")).alias("ended_line_share"),
        ratio(n("common_words"), n("words")).alias("common_word_share"),
        ratio(n("repeats"), n("words")).alias("repeat_share"),
        ratio(prose, weighed).alias("prose_share"),
        ratio(n("list_chars"), weighed).alias("list_share"),
        ratio(n("table_chars"), weighed).alias("table_share"),
        ratio(junk, weighed).alias("junk_share"),
        kind.alias("kind"),
    )
