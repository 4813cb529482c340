"""Problem 9: pages of repeated keywords, lists of links or product tags, told by the shapes of their lines."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.runtime import col

# Frequent function words of the languages written with spaces.
STOPWORDS = {
    "en": "the a an and or of to in on at for with without by from is are was were be been it its this that as but not no so we you they i he she our your their which who when where how what why if than then there here has have had do does did can should would will only about after before until into over under out more most some any each every all both one two while because since".split(),
    "de": "der die das den dem des ein eine einer eines und oder aber nicht mit von zu zum zur im in ist sind war wurde wird auf für als bei aus nach vor wie wenn weil dass sich es er sie wir man nur noch auch so hat haben was alle um seit damit".split(),
    "fr": "le la les un une des du de et ou mais ne pas avec sans pour par sur dans est sont était a au aux ce cette qui que quand parce il elle on nous vous leur se sa son plus même d l qu n s y en dès depuis".split(),
    "es": "el la los las un una unos unas y o pero no con sin por para en es son era de del al que se su lo como cuando porque más este esta eso ya nos desde entre cada a".split(),
    "pt": "o os as um uma e ou mas não com sem por para em é são era de do da dos das ao que se seu sua como quando porque mais este esta isso já nos desde entre cada".split(),
    "it": "il lo la i gli le un una e o ma non con senza per in è sono era di del della al che si suo come quando perché più questo questa già ci da tra ogni".split(),
}
ANY_STOPWORD = frozenset(w for words in STOPWORDS.values() for w in words)

LINK = re.compile(r"<a\s[^>]*>|\]\([^)\s]*\)|https?://\S+|www\.\S+", re.I)
TAG = re.compile(r"</?[a-z][^>]*>", re.I)
WORD = re.compile(r"[^\W\d]\w*(?:['’]\w+)?")
SENTENCE_END = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])")
CJK = re.compile(r"[぀-ヿ㐀-鿿가-힯]")
HANGUL, KANA = re.compile(r"[가-힯]"), re.compile(r"[぀-ゟ゠-ヿ]")
# Function characters of Chinese, of Japanese, and last syllables of Korean words.
HAN_MARKS = frozenset("的了是在和与與不有这這那为為以对對从從把被将將而也就都及或等会會要能并並其之由们們它我你他")
KANA_MARKS = frozenset("はがをにでとものてしたるれいますなだへかりくらうよ")
HANGUL_MARKS = frozenset("은는이가을를에의로와과도다고요며서면한할된")
CJK_CUT = re.compile(r"[、，,;；|·・•★/／#＃\t\u3000>]+")
CJK_CUT_BLANK = re.compile(rf"{CJK_CUT.pattern}|\s+")
SEPARATORS = re.compile(r"\s>>\s|\s[|·;/★•–—-]\s|[|·;★•\t]|,\s")
CODE_START = re.compile(
    r"\s*(?:[-#/*]+[^\n]{0,200}\s|\w{1,8}:\s+)?(?:select\b.*\bfrom\b|with\s+\w+\s+as\b|insert\s+into\b|update\s+\S+\s+set\b|delete\s+from\b|merge\s+into\b|create\s+(?:table|view|index)\b"
    r"|(?:where|and|on|group\s+by|order\s+by|having|limit|values|join|from|set)\b.*[=<>(\d]|[\"`\w]+\s+(?:integer|int|text|decimal|date|real|varchar|bigint|boolean)\b.*[,)]?\s*$|[)};\]]+;?\s*$)"
    r"|\s*[\[{]\s*[\"'{\[]|\s*(?:def|class|import|return|for|while|if)\b.*[:(]\s*|\s*\w+\s*=\s*\S+",
    re.I,
)
CALL = re.compile(r"\w\([^)]{0,300}\)\s*[;{]")
NUMBER = re.compile(r"[-+]?[\d.,:%eE/-]*\d[\d.,:%]*|:?-+:?|null|nan|true|false", re.I)
CELL = re.compile(r"[|\t;,]")
#: A page is spam if shapes that are no sentence, code or data make up more than this share of its weight.
DOMINATED = 0.5
#: So many of the most frequent shapes count as few, or one for each PARTS_A_SHAPE parts of a longer page.
FEW, PARTS_A_SHAPE = 6, 4
#: A page with fewer characters in such shapes is too short to tell.
LEAST_WEIGHT = 60
#: A sentence of fewer words is too short to tell.
SENTENCE_WORDS = 6
#: Least share of function words in a sentence, and greatest share of content words that it says twice.
FUNCTION_SHARE, REPEATED_SHARE = 0.12, 0.34
#: Sentences of languages without known function words: they end like sentences, and least share of their word triples that the page has once.
FULL_STOP = re.compile(r"[.!?…:;।؟۔։][\"'”’»)\]]*\s*$")
NEW_SHARE = 0.5


def code_line(line: str) -> bool:
    """Whether a line begins like a statement, opens a block, or calls something and ends there."""
    return bool(CODE_START.match(line)) or line.rstrip().endswith(("{", "[", "(")) or "(" in line and (";" in line or "{" in line) and bool(CALL.search(line))


def data_row(line: str) -> bool:
    """Whether at least half of a line's three or more cells are numbers or rules."""
    if line.count(",") + line.count("|") + line.count(";") + line.count("\t") < 2:
        return False
    cells = [c.strip() for c in CELL.split(line.strip().strip("|"))]
    return len(cells) >= 3 and 2 * sum(NUMBER.fullmatch(c) is not None for c in cells) >= len(cells)


def cjk_sentence(part: str) -> bool:
    """Whether a part in Chinese, Japanese or Korean reads as a sentence: function characters, no runs said again, no chain of short items."""
    hangul = len(HANGUL.findall(part))
    chars = CJK.findall(part)
    grams = ["".join(g) for g in zip(chars, chars[1:], chars[2:], chars[3:])]
    if len(grams) >= 8 and 2 * len(set(grams)) < len(grams):
        return False
    if 2 * hangul >= len(chars):  # blanks part words in Korean, and items in the others
        ends = [w[-1] for w in WORD.findall(part) if HANGUL.match(w[-1])]
        found, units, least = [e for e in ends if e in HANGUL_MARKS], len(ends), 0.25
    else:
        marks, least = (KANA_MARKS, 0.15) if 8 * len(KANA.findall(part)) >= len(chars) else (HAN_MARKS, 0.04)
        found, units = [c for c in chars if c in marks], len(chars)
    items = [i for i in (CJK_CUT if 2 * hangul >= len(chars) else CJK_CUT_BLANK).split(part) if CJK.search(i)]
    chain = len(items) >= 3 and len(chars) < 8 * len(items)
    return len(found) >= (2 * least if chain else least) * units and len(set(found)) >= (2 if chain or len(chars) >= 20 else 1)


def sentence(part: str, words: list[str], cells: int) -> bool:
    """Whether a part of a line reads as a sentence: function words, few content words said again, no chain of short items."""
    n = len(words)
    cjk = 0 if part.isascii() else len(CJK.findall(part))
    if cjk >= 6 and cjk * 2 >= n and cjk_sentence(part):
        return True
    if n < SENTENCE_WORDS:
        return False
    functional = [w for w in words if w in ANY_STOPWORD]
    chain = cells >= 3 and n < 4 * cells
    open_end = n < 10 and not part.rstrip().endswith((".", "!", "?", "…", ":", ")"))  # a phrase, unless it is well linked
    if len(functional) < FUNCTION_SHARE * n or len(set(functional)) < (4 if chain else 3 if open_end else 2):
        return False
    counts = Counter(w for w in words if w not in ANY_STOPWORD)
    again = sum(c for c in counts.values() if c > 1)
    return again <= REPEATED_SHARE * n or again <= 4 < n / 3


def triples(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(words, words[1:], words[2:]))


def foreign_sentence(part: str, words: list[str], cells: int, times: int, seen: Counter) -> bool:
    """Whether a part reads as a sentence whatever its language: it ends like one, is no chain of short items, says few
    words again, stands on the page twice at most, and is put together anew: at least half of its word triples stand in
    no other part of the page (seen: the parts of each triple)."""
    n = len(words)
    if n < SENTENCE_WORDS or n < 4 * cells or times > 2 or not FULL_STOP.search(part):
        return False
    again = sum(c for c in Counter(w for w in words if len(w) > 2).values() if c > 1)
    mine = triples(words)
    return again <= REPEATED_SHARE * n and sum(seen[t] == 1 for t in mine) >= NEW_SHARE * len(mine)


def capitals(words: list[str]) -> str:
    ups = sum(w[0].isupper() for w in words)
    return "-" if not words else "0" if not ups else "C" if 2 * ups >= len(words) else "c"


def shapes(text: str) -> tuple[Counter, Counter, int]:
    """(weights of sentence, code and data, weights of the other shapes, parts of other shapes) of a text; a weight counts characters."""
    good: Counter = Counter()
    other: Counter = Counter()
    doubtful: list[tuple[str, list[str], int, float, str]] = []
    parts = 0
    every: list[list[str]] = []
    for line in text.splitlines():
        if not line or line.isspace():
            continue
        links = len(LINK.findall(line)) if ("http" in line or "www." in line or "href" in line or "](" in line) else 0
        if not links and code_line(line):
            good["code"] += len(line)
            continue
        if not links and data_row(line):
            good["data"] += len(line)
            continue
        bare = LINK.sub(" ", line) if links else line
        if "<" in bare:
            bare = TAG.sub(" ", bare)
        weight = len(line) / max(1, len(bare))
        for part in SENTENCE_END.split(bare):
            if not part or part.isspace():
                continue
            lower = WORD.findall(part.lower())
            seps = SEPARATORS.findall(part)
            cells = len(seps) + 1
            every.append(lower)
            if links * 8 <= len(lower) and sentence(part, lower, cells):
                good["sentence"] += len(part) * weight
                continue
            words = WORD.findall(part)
            mark = Counter(s.strip() for s in seps).most_common(1)[0][0] if seps else ""
            size = min(9, round(len(words) / cells))
            tag = "#" if "#" in part and part.count("#") * 3 > len(words) else ""
            kind = f"{'link ' if links else ''}{tag}{size}w{capitals(words)}{mark}"
            if links * 8 <= len(words) and len(lower) >= SENTENCE_WORDS:
                doubtful.append((part, lower, cells, len(part) * weight, kind))
            else:
                other[kind] += len(part) * weight
            parts += 1
        if links and not bare.strip():
            other["link 0w-"] += len(line)
            parts += 1
    said: Counter = Counter()
    seen: Counter = Counter()
    if any(FULL_STOP.search(d[0]) for d in doubtful):
        said.update(map(tuple, every))
        for words in said:
            seen.update(set(triples(words)))
    for part, lower, cells, size, kind in doubtful:
        if foreign_sentence(part, lower, cells, said[tuple(lower)], seen):
            good["sentence"] += size
            parts -= 1
        else:
            other[kind] += size
    return good, other, parts


def judge(text: str | None) -> tuple[bool, float, str | None]:
    """(spam, share of the weight in few non-sentence shapes, most frequent such shape)."""
    if not text or text.isspace():
        return False, 0.0, None
    good, other, parts = shapes(text)
    total = sum(good.values()) + sum(other.values())
    if not total or not other:
        return False, 0.0, None
    top = other.most_common(max(FEW, parts // PARTS_A_SHAPE))
    share = sum(w for _, w in top) / total
    return share > DOMINATED and sum(other.values()) >= LEAST_WEIGHT, round(share, 4), top[0][0]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [judge(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([g[0] for g in got], pa.bool_()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.string())],
            names=["id", "spam", "share", "shape"],
        )


def judged_pages(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spam, share, shape) of each row: whether non-sentence shapes dominate the page, their share, the main one.

    Null, empty and blank texts are no spam, with share 0 and no shape. Each row is judged alone, in one pass without a
    shuffle, so repeated rows get the same answer and skew has no effect.
    """
    base = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return base.mapInArrow(_run, f"id {base.schema['id'].dataType.simpleString()}, spam boolean, share double, shape string")


def shape_report(judged: DataFrame) -> DataFrame:
    """Pages and flagged pages of each main shape."""
    return judged.filter("shape is not null").groupBy("shape").agg(F.count("*").alias("n_pages"), F.count_if("spam").alias("n_spam"))
