"""Problem 5: broken prompt and response pairs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.runtime import col

EMPTY, TRUNCATED, REFUSAL, COPIED, LANGUAGE = "empty_answer", "truncated", "refusal", "copied_question", "wrong_language"

# Answers that stand for no answer, as their letters and digits.
PLACEHOLDERS = frozenset(
    "null none na n/a nan nil empty blank todo tbd tba undefined missing placeholder unknown fixme xxx sql query answer response output text string insert here your query here no answer not available not applicable".split(" ")
) | frozenset(["n a", "your query here", "your answer here", "no answer", "no response", "not available", "not applicable", "insert query here", "to do", "coming soon", "write your query here", "sql here", "answer here"])

# The parts of English refusals, lower-cased, with straight apostrophes; refusal_phrases() joins them.
SELVES = "i | we | this assistant".split(" | ")
UNABLE = """cannot | can't | can not | could not | couldn't | won't | will not | am unable | are unable | 'm unable | 're unable | am not able | are not able | 'm not able | must decline | have to decline
decline | respectfully decline | refuse | must refuse | have to refuse | must pass | have to pass | 'll pass | will pass | don't have access | do not have access | don't have enough | do not have enough
have no access | 'd rather not | would rather not | 'd prefer not | would prefer not | prefer not | am sorry | 'm sorry | apologize | apologise | am not allowed | 'm not allowed | am not permitted | 'm not permitted"""
HINDERED = "cannot | can't | can not | won't | will not | unable to | not able to | not allowed to | not permitted to | not willing to | unwilling to | refuse to | prefer not to | rather not | impossible to | not possible to".split(" | ")
ACTS = "help | assist | answer | provide | generate | produce | write | give | comply | create | do that | do this | fulfil | complete this | process this | share | turn | translate | respond | proceed | continue".split(" | ")
RULES = [f"{how} {whose} {what}" for how in ("against", "violates", "violate", "outside", "breaks", "contrary to") for whose in ("my", "our", "the") for what in ("guidelines", "guideline", "policy", "policies", "rules", "instructions", "principles", "scope")]
NOTHING = [f"no {what} {state}" for what in ("query", "sql", "answer", "statement", "response") for state in ("can be", "could be", "will be", "is possible")]
WHOLE = """sorry, | sorry but | so sorry | my apologies | apologies for | apologies, | outside what i may | outside what i can | outside of what i | unable to comply | request declined | declined | request denied | access denied | refused | refusal
as an ai | as a language model | as an assistant | not appropriate | not be appropriate | n't appropriate | n't be appropriate | be inappropriate | is inappropriate | inappropriate for me | isn't possible for me | is not possible for me | unfortunately i | unfortunately, i | not comfortable"""
# Phrases of refusals in other languages.
FOREIGN = """lo siento | no puedo | no me es posible | je ne peux pas | je suis désolé | désolé, | es tut mir leid | ich kann nicht | ich kann das nicht | leider kann ich | não posso | desculpe | mi dispiace | non posso
nie mogę | przykro mi | het spijt me | ik kan niet | jag kan inte | tyvärr kan | не могу | к сожалению | извините | 申し訳 | できません | 抱歉 | 对不起 | 无法 | 죄송"""

# Everyday function words (articles, pronouns, prepositions, conjunctions, auxiliaries) of languages in Latin script,
# as any grammar lists them; words of SQL vote for SQL, whatever else they are.
VOTES = {
    "en": "the a an of to for at that this these those it its which who whose whom each every you your we our they their he she i should would could can will must may be been are was were has have had do does if than so just only then there here".split(),
    "de": "der die das den dem des ein eine einen einem einer und oder aber nicht kein keine mit von vom zu zum zur im ist sind war wird werden aus auf für bei nach vor über unter wie wenn weil dass sich sie wir man nur noch auch so hat haben alle wo welche deren dessen mindestens zwischen".split(),
    "fr": "le la les un une des du de et ou mais ne pas avec sans pour par sur dans est sont était au aux ce cette ces qui que quand dont où il elle on nous vous leur se sa son ses plus puis depuis entre chaque tous toutes faut".split(),
    "es": "el la los las un una unos unas y o pero no con sin por para en es son era de del al que se su sus lo como cuando donde porque más este esta cuyo cuya hay entre cada desde hasta todos todas después".split(),
    "pt": "o a os as um uma uns umas e ou mas não com sem por para em é são era de do da dos das no na nos nas ao que se seu sua como quando onde porque mais este esta cujo cuja entre cada desde até todos todas".split(),
    "it": "il lo la i gli le un una uno e o ma non con senza per di del della dei delle da dal che si suo sua come quando dove perché più questo questa cui tra ogni è sono nel nella tutti".split(),
    "nl": "de het een en of maar niet geen met zonder van voor op te aan bij uit naar is zijn was wordt worden dat die deze dit wie wat waar als dan ook nog alle elke er je wij ze hun tussen".split(),
    "pl": "i w z na do od po za o u a lub albo oraz ale nie jest są był dla przez przy przed nad pod jak gdy gdzie który która które których to ten ta te się tylko każdy wszystkie między".split(),
    "sv": "en ett den det de och eller men inte med utan av för på till från är var som att där när om sig sin vi ni han hon alla varje mellan".split(),
    "cs": "a i nebo ale ne s se si z ze do od po na v ve k ke pro při před nad pod je jsou byl jak kde když který která které to ten ta jen každý všechny mezi".split(),
    "tr": "bir ve veya ama ile için bu şu o da de ki mi ne gibi daha çok olan olarak her kadar sonra önce arasında tüm".split(),
}
SQL_WORDS = frozenset(
    "select from where and or not in between like is null on join inner left right full cross outer by group order having set values into insert update delete union all intersect except as with case when then else end over partition limit offset distinct exists using merge any asc desc count sum avg min max".split()
)
VOTE: dict[str, list[str]] = {}
for _lang, _words in VOTES.items():
    for _w in _words:
        if _w not in SQL_WORDS:
            VOTE.setdefault(_w, []).append(_lang)
#: Traces of programming and query languages: calls on objects, arrows, pipes, definitions, filters in brackets, variables.
CODE = re.compile(
    r"\b\w+(?:\.\w+)+\s*\(|=>|->|<-|%>%|\|>|::|\+=|==|&&|\|\||\$\w+|\?\w+\s+\w*:\w+|\b\w+\[[^\]]*[<>=(]|\{\s*[\"']?\$?\w+[\"']?\s*:|\bimport\s+\w+|\bdef\s+\w+\s*\(|\bfunction\b|\blambda\b|\bMATCH\s*\(|\breturn\b|\bfor\s+\w+\s+in\b"
    r"|\bvar\s+\w+|\blet\s+\w+|\bconst\s+\w+|\bprint\w*\s*\(|^\s*\w+\s*=\s*\S|^\s*\w+\s*\|\s*\w+\s|\bPREFIX\s+\w*:|#include|<\?php|</?\w+[^<>]*>",
    re.I | re.M,
)
LETTER = re.compile(r"[^\W\d_]")
OTHER_SCRIPT = re.compile(r"[\u0370-\u1dff\u2c00-\ua6ff\ua800-\ud7ff\uf900-\ufdff\ufe70-\uffee]")  # letters beyond the Latin ones
QUOTED = re.compile(r"'(?:[^']|'')*'|\"[^\"]*\"")

WORDS = re.compile(r"[^\W_]+")
UNBLANKED = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_぀-ヿ㐀-鿿]+")  # scripts written without blanks count by character
UNBLANKED_CHAR = re.compile(r"[぀-ヿ㐀-鿿]")
BLANK = re.compile(r"[\s​‌‍⁠﻿­]+")
FENCE = re.compile(r"^\s*(?:```|~~~)[ \t]*(?:[A-Za-z]{1,12}(?=\s|$))?|(?:```|~~~)[\s;.]*$")
VERB = r"(?:select|insert|update|delete|with|merge|create|alter|drop|replace)\b"
WRAPPED = re.compile(rf"^\s*`(?=\s*(?:{VERB}|--|/\*|\())", re.I)
LEXER = re.compile(
    r"(?P<comment>--[^\n]*|/\*.*?\*/)|(?P<open_comment>/\*.*)"
    r"|(?P<string>'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|‘[^’]*’|“[^”]*”)|(?P<open_string>['\"`‘“].*)"
    r"|(?P<number>\d[\d.]*)|(?P<word>[^\W\d]\w*)|(?P<dots>\.\.\.|…)|(?P<op><\s*>|[<>!]\s*=|[-+*/%=<>.,;()\[\]{}])|(?P<other>\S)",
    re.S,
)
#: No statement ends with one of these words or marks.
UNFINISHED = frozenset(
    "select from where and or not in between like is on join inner left right full cross outer by group order having set values into insert update delete union all intersect except as with case when then else over partition limit offset distinct exists using merge any interval".split()
) | {",", "=", "<", ">", "<>", "<=", ">=", "!=", "(", "[", "{", ".", "+", "-", "/", "%", "..."}
PREDICATE = frozenset("= < > <> <= >= != in like between is exists ilike regexp".split())
CLAUSE = frozenset("where and or on having when".split())
KEYWORDS = UNFINISHED | frozenset("asc desc end null true false fetch first last nulls rows only returning matched".split())
LITERAL = re.compile(r"\s*select\s+'((?:[^']|'')*)'(?:\s+as\s+\w+)?\s*;?\s*", re.I)
LEADS = frozenset("question sql answer query prompt response".split())
MIN_RUN = 4
COVERED = 0.8

_refusals = None


def refusal_phrases() -> set[str]:
    parts = lambda text: [x.strip() for x in re.split(r"[|\n]", text) if x.strip()]
    joined = [who + ("" if what[0] == "'" else " ") + what for who in SELVES for what in parts(UNABLE)]
    return {*joined, *(f"{no} {act}" for no in HINDERED for act in ACTS), *RULES, *NOTHING, *parts(WHOLE), *parts(FOREIGN)}


def refusal_automaton():
    """An Aho-Corasick automaton of the phrases, made once in each worker."""
    global _refusals
    if _refusals is None:
        import ahocorasick

        _refusals = ahocorasick.Automaton()
        for phrase in refusal_phrases():
            _refusals.add_word(phrase, phrase)
        _refusals.make_automaton()
    return _refusals


class SuffixAutomaton:
    """Suffix automaton of a prompt's words: it accepts every run of words of the prompt."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in words:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[q] == self.length[p] + 1:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def covered(self, words: list[str], min_run: int = MIN_RUN) -> int:
        """Words that lie in runs of at least min_run words that the prompt has too."""
        state = run = total = reached = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                run += 1
            else:
                run = 0
            if run >= min_run:
                begin = max(reached, i - run + 1)
                total += i + 1 - begin
                reached = i + 1
        return total


def unwrap(answer: str) -> str:
    """The answer without code fences and a pair of backticks around it."""
    text = answer.strip()
    if "```" in text or "~~~" in text:
        text = FENCE.sub("", FENCE.sub("", text, count=1), count=1).strip()
    if WRAPPED.match(text):
        text = text[1:].strip()
        text = text[:-1] if text.endswith("`") and text.count("`") % 2 else text
    return text


def lex(text: str) -> list[tuple[str, str]]:
    return [(m.lastgroup, m.group()) for m in LEXER.finditer(text)]


def statement(text: str) -> list[tuple[str, str]] | None:
    """The tokens of the SQL statement that text holds, without comments, or None where it holds none."""
    tokens = [t for t in lex(text) if t[0] != "comment"]
    if not any(k in ("word", "number", "string", "open_string") for k, _ in tokens):
        hidden = re.search(rf"\b{VERB}.*\b(?:from|into|set|as)\b.*", text, re.I | re.S)  # line breaks lost behind a comment mark
        tokens = [t for t in lex(hidden.group()) if t[0] != "comment"] if hidden else []
    while tokens and (tokens[0][1] in "(;" or tokens[0][0] == "open_comment" and len(tokens) > 1):
        tokens = tokens[1:]
    if not tokens or tokens[0][0] != "word":
        return None
    first = tokens[0][1].lower()
    second = tokens[1][1].lower() if len(tokens) > 1 else ""
    words = {w.lower() for k, w in tokens if k == "word"}
    third = tokens[2][1].lower() if len(tokens) > 2 else ""
    # a verb of SQL that begins a sentence of English has no FROM, INTO, SET or AS in its place
    if first == "select":
        return tokens if "from" in words and second != "the" or select_list(tokens) else None
    if first in ("insert", "merge", "replace"):
        return tokens if second in ("into", "") else None
    if first == "delete":
        return tokens if second in ("from", "") else None
    if first == "update":
        named = [w for _, w in tokens[1:6]]
        return tokens if "set" in [w.lower() for w in named] or len(tokens) <= 4 else None
    if first == "with":
        return tokens if third in ("as", "", "(") or second == "recursive" else None
    if first in ("create", "alter", "drop"):
        return tokens if second in ("table", "view", "index", "or", "temporary", "database", "schema") else None
    return None


def select_list(tokens: list[tuple[str, str]]) -> bool:
    """Whether what follows SELECT, without a FROM, can be a list of columns that breaks off."""
    rest = [t for t in tokens[1:] if t[1] not in (";",)]
    if not rest:
        return True
    plain = all(k in ("word", "number", "open_string", "dots") or w in ",.()*`[]" or k == "string" and w[0] in "`\"[" for k, w in rest)
    runs = sum(a[0] == b[0] == "word" and a[1].lower() not in KEYWORDS and b[1].lower() not in KEYWORDS for a, b in zip(rest, rest[1:]))
    return plain and runs == 0


def breaks_off(tokens: list[tuple[str, str]], text: str, prompt: list[str]) -> bool:
    """Whether a statement ends before it is complete: open delimiters, or an end that nothing can follow on from."""
    if any(k in ("open_string", "open_comment", "dots") for k, _ in tokens):
        return True
    if re.search(r"(?:\.\.\.|…|\[(?:cut|truncated|\.\.\.)\]|\((?:continued|truncated|cut)\)?)\s*$", text, re.I):
        return True
    stack: list[str] = []
    pairs = {")": "(", "]": "[", "}": "{"}
    for kind, w in tokens:
        if kind == "op" and w in "([{":
            stack.append(w)
        elif kind == "op" and w in pairs:
            if stack and stack[-1] == pairs[w]:
                stack.pop()
    if stack:
        return True
    body = [(k, "".join(w.split()) if k == "op" else w.lower()) for k, w in tokens]
    while body and body[-1][1] == ";":
        body.pop()
    closed = tokens[-1][1] == ";"
    while body and body[-1] == ("op", ")") and body.count(("op", ")")) > body.count(("op", "(")):
        body.pop()  # the end of a bracket around the whole statement
    if not body:
        return True
    kind, last = body[-1]
    if last in UNFINISHED and kind in ("word", "op"):
        return True
    words = [w for k, w in body if k == "word"]
    kinds = [w if k in ("word", "op") else k for k, w in body]
    first = kinds[0]
    if first == "select" and "from" not in words:
        return True
    if first == "insert" and not {"values", "select", "default"} & set(words):
        return True
    if first == "update" and ("set" not in words or "=" not in kinds[kinds.index("set") :]):
        return True
    if first == "delete" and "from" not in words or first == "with" and not depth_zero(kinds, ("select", "insert", "update", "delete")):
        return True
    if words.count("case") > words.count("end"):
        return True
    # the last condition must have an operator, and a BETWEEN its AND
    clause, between = None, False
    for w in kinds:
        if w == "between":
            between, clause = True, True
        elif w == "and" and between:
            between = False
        elif w in CLAUSE:
            clause = False
        elif w in PREDICATE:
            clause = True if clause is not None else clause
        elif w in ("by", "limit", "select", "from", "values", "set", "join", "union"):
            clause = None
    if between or clause is False and kinds[-1] != ")" and "not" not in kinds[-3:]:
        return True
    if clause is False and kinds[-1] == ")" and "having" in kinds[-6:]:
        return True
    if len(kinds) >= 2 and kind == "word" and last not in KEYWORDS:
        if kinds[-2] in ("string", "number") and "limit" not in kinds[-3:-1] or kinds[-2] == "string":
            return True
        if len(body) >= 4 and "order" in words and kinds[-3] == "by" and body[-2][0] == "word" and body[-2][1] not in KEYWORDS:
            return True
    if not closed and kind in ("word", "number") and not (kind == "number" and kinds[-2:-1] in (["by"], [","])):
        piece = WORDS.findall(last)
        if piece and piece[-1] not in prompt and last not in KEYWORDS and len(piece[-1]) > 2:
            tail = piece[-1]
            whole = [p for p in prompt if p.startswith(tail) and p != tail]
            if whole and not (kind == "word" and any(p + "s" == q or q + "s" == p for p in whole for q in piece)):
                return True
    return False


def depth_zero(kinds: list[str], verbs: tuple[str, ...]) -> bool:
    depth = 0
    for w in kinds:
        depth += (w == "(") - (w == ")")
        if depth == 0 and w in verbs:
            return True
    return False


def other_language(text: str, words: list[str]) -> str | None:
    """The kind of language other than SQL that a text without a statement is in: script, code, or a language's name; else None.

    A fifth of the letters in another script, or a trace of code, decides. Otherwise each function word votes for its
    languages and each word of SQL for SQL, names in quotes left out: the language with the most votes wins if it has
    two different words at least and more votes than SQL. A text of which none of this holds is in no language known.
    """
    letters = len(LETTER.findall(text))
    if letters and 5 * len(OTHER_SCRIPT.findall(text)) >= letters:
        return "script"
    if CODE.search(QUOTED.sub("''", text)):
        return "code"
    said = WORDS.findall(QUOTED.sub(" ", text.lower())) if "'" in text or '"' in text else words
    votes: dict[str, int] = {}
    kinds: dict[str, set[str]] = {}
    sql = 0
    for w in said:
        sql += w in SQL_WORDS
        for lang in VOTE.get(w, ()):
            votes[lang] = votes.get(lang, 0) + 1
            kinds.setdefault(lang, set()).add(w)
    best = max(votes, key=lambda lang: (votes[lang], len(kinds[lang]), lang), default=None)
    return best if best and len(kinds[best]) >= 2 and votes[best] > sql else None


def copies(prompt: str, asked: list[str], text: str, words: list[str]) -> bool:
    """asked, words: the words of prompt and text. Whether runs of the prompt cover the text: runs of MIN_RUN words, or of the whole prompt where it is shorter."""
    if literal := LITERAL.fullmatch(text):  # a wrapping would outweigh a short prompt
        words = UNBLANKED.findall(literal.group(1).lower())
    elif UNBLANKED_CHAR.search(text):
        words = UNBLANKED.findall(text.lower())
    if UNBLANKED_CHAR.search(prompt):
        asked = UNBLANKED.findall(prompt.lower())
    first = 0
    while len(words) - first > len(asked) and words[first] in LEADS:
        first += 1
    words = words[first:]
    least, needed = min(MIN_RUN, len(asked)), COVERED * len(words)
    known, run, reach = set(asked), 0, 0
    for w in words:  # a run of the prompt holds no word that the prompt lacks
        if w in known:
            run += 1
        else:
            reach += run if run >= least else 0
            run = 0
    if reach + (run if run >= least else 0) < needed:
        return False
    return SuffixAutomaton(asked).covered(words, least) >= needed


def defect(prompt: str | None, answer: str | None) -> str | None:
    """The defect of an answer, or None. The first that holds of: empty, sound or broken SQL, refusal, copy, other language.

    An answer that is no statement and of which none of these can be told, such as a lone name or number, has no defect
    that this operator names.
    """
    if answer is None:
        return EMPTY
    text = unwrap(BLANK.sub(" ", answer) if not answer.strip() else answer)
    words = WORDS.findall(text.lower())
    if not words or (len(words) <= 5 and (" ".join(words) in PLACEHOLDERS)):
        return EMPTY
    asked = WORDS.findall(prompt.lower()) if prompt else []
    tokens = statement(text)
    copied = copies(prompt, asked, text, words) if asked else False
    if tokens is not None and not copied:
        only_text = [w for k, w in tokens if k == "string"]
        if not (len(tokens) <= 8 and only_text and tokens[0][1].lower() == "select" and not any(w.lower() == "from" for k, w in tokens if k == "word")):
            return TRUNCATED if breaks_off(tokens, text, asked) else None
    lower = text.lower().replace("’", "'").replace("`", "'").replace("''", "'")  # a literal doubles its apostrophes
    if any(True for _ in refusal_automaton().iter(lower)):
        return REFUSAL
    if copied:
        return COPIED
    if tokens is not None:
        return None
    if other_language(text, words):
        return LANGUAGE
    said = any(k in ("word", "number", "string", "open_string") for k, _ in lex(text) if k != "comment")
    return None if said else EMPTY


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [defect(p, a) for p, a in zip(batch.column("prompt").to_pylist(), batch.column("answer").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], names=["id", "defect_type"])


def flagged(df: DataFrame, id_col: str, prompt_col: str, answer_col: str) -> DataFrame:
    """(id, defect_type) of each row of df whose answer has a defect; at most one for a row.

    A null answer is empty; a null or blank prompt is no defect and copies nothing; repeated rows are flagged each; rows
    are judged alone in one pass without a shuffle, whole texts of any length. Other columns are never read.
    """
    base = df.select(col(id_col).alias("id"), col(prompt_col).cast("string").alias("prompt"), col(answer_col).cast("string").alias("answer"))
    return base.mapInArrow(_run, f"id {base.schema['id'].dataType.simpleString()}, defect_type string").filter("defect_type is not null")
