"""Secrets in texts: fixed patterns, and assignment-aware lexing of source and configuration syntax.

The lexer reads a text into names, literals and signs and puts together (name, literal) pairs of ``name = "literal"``,
``"name": "literal"``, ``name: literal``, ``NAME=literal``, ``<name>literal</name>`` and ``name="a" + "b"``, also with a type or an array size
between name and sign and with the name as a key in brackets. A name that is assigned to another one hands its literal on, so a constant that ends in a sensitive name is found where it is written.
Literals are scored by how sensitive the names are that they reach.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloflow.llm.common import fresh

#: The patterns of the contract, with the least length of what they find.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same as runs of [0-9a-f]+ without those under 24
KINDS = ("assign", "access", "hex", "literal")
MASK = "[SECRET]"

#: Parts of names, with the weight of a name that has them.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 2, "secret": 3, "token": 2, "apikey": 3, "api_key": 3, "credential": 2,
    "private_key": 3, "privatekey": 3, "access_key": 3, "accesskey": 3, "auth": 1, "bearer": 2, "client_key": 2, "signing_key": 3, "encryption_key": 3,
}
#: How they are written in lower-cased texts.
SPELLINGS = sorted({part.replace("_", joint) for part in SENSITIVE for joint in ("_", "-", ".", "")})
#: Whole parts of names that hold no secret although a sensitive part is in them.
HARMLESS = (
    "author", "authors", "authored", "authority", "authorities", "token_count", "token_counts", "tokenizer", "tokenizers", "max_token", "max_tokens",
    "secretary", "secretaries", "password_hint", "password_hints",
)
#: Whole parts of names of what stands beside a secret, more often than the secret itself: they take 2 from the weight.
BESIDES = ("field", "fields", "label", "labels", "policy", "policies")
#: Names whose literals may have spaces, and values that do under other names.
PHRASES = ("passphrase", "password", "passwd", "pwd")
SCHEME = re.compile(r"(?i)(?:bearer|basic|token|digest)\x20+\S+")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|undefined|changeme|example|placeholder|your[-_ ].*|<.*>|\$\{.*\}|%\(.*\)s|\{\{.*\}\})$")
MIN_LENGTH = 6
#: Each name above reaches it: weight 3 with any literal, 2 with two classes of characters or a bit a character, 1 with two
#: classes and 3 bits a character (hexadecimal keys), or three classes.
MIN_SCORE = 2.25

NAME = r"[A-Za-z_$][A-Za-z0-9_$.\-]*"
#: Words, strings with escapes, signs of assignment and joining; anything else separates.
LEX = re.compile(
    rf"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)|(?P<tag><({NAME})>(?P<inner>[^<>\n]+)</\3>)|(?P<word>[A-Za-z0-9_$][A-Za-z0-9_$.\-/+]*)|(?P<sign>:=|=>|==|!=|<=|>=|[=:+,;()\[\]{{}}]|\n)|(?P<other>[^\sA-Za-z0-9_$])"""
)
SIGNS = ("=", ":", ":=", "=>")
#: Words that are a type, or part of one, between a name and its sign.
TYPES = frozenset("str string bytes byte char wchar text varchar nvarchar object any final optional option const static mut none null undefined literal secretstr".split())
DECLARES = frozenset("const var let val static declare".split())
#: Lexemes of a type that are looked through for the sign after it.
TYPE_REACH = 12


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, leftmost and without overlap within a kind."""
    spans = []
    if any(c in text for c in "=:"):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def flat_name(name: str) -> str:
    """Camel case, dashes and dots are read as underscores."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower().replace("-", "_").replace(".", "_")


def sensitivity(name: str) -> int:
    """Weight of a name."""
    flat = flat_name(name)
    whole = f"_{flat}_"
    if any(f"_{h}_" in whole for h in HARMLESS):
        return 0
    weight = max((w for part, w in SENSITIVE.items() if part in flat), default=0)
    return max(weight - 2 * any(f"_{b}_" in whole for b in BESIDES), 0)


def entropy(literal: str) -> float:
    """Bits for each character."""
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in Counter(literal).values()) if n else 0.0


def takes_phrases(name: str) -> bool:
    return any(p in flat_name(name) for p in PHRASES)


def score_by(weight: float, phrases: bool, literal: str) -> float:
    """Weight of a name plus how unlike a word the literal is; zero for short literals and placeholders."""
    if not weight or len(literal) < MIN_LENGTH or PLACEHOLDER.match(literal):
        return 0.0
    if not phrases and " " in literal.strip() and not SCHEME.fullmatch(literal.strip()):
        return 0.0
    kinds = sum(bool(re.search(k, literal)) for k in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
    return weight + 0.5 * (kinds - 1) + min(entropy(literal), 4.0) / 4


def score(name: str, literal: str) -> float:
    return score_by(sensitivity(name), takes_phrases(name), literal)


def _after_brackets(lexemes: list[re.Match[str]], i: int) -> int:
    """The lexeme after a closing bracket and array sizes: of ``config["name"] =`` and ``name[32] =`` the sign."""
    if i < len(lexemes) and lexemes[i]["sign"] == "]":
        i += 1
    while i < len(lexemes) and lexemes[i]["sign"] == "[":
        size = i + 1 + (i + 1 < len(lexemes) and bool(lexemes[i + 1]["word"]))
        if size >= len(lexemes) or lexemes[size]["sign"] != "]":
            break
        i = size + 1
    return i


def _after_type(lexemes: list[re.Match[str]], i: int) -> int | None:
    """The sign of assignment after a type that begins at ``i``, on the same line; None if no type is there."""
    depth = words = 0
    for k in range(i, min(i + TYPE_REACH, len(lexemes))):
        m = lexemes[k]
        if m["sign"] in ("=", ":=") and not depth:
            return k if words else None
        if m["word"] or m["string"]:
            words += 1
        elif m["sign"] in ("[", "("):
            depth += 1
        elif m["sign"] in ("]", ")") and depth:
            depth -= 1
        elif not (m["sign"] == ":" or (m["sign"] == "," and depth)):
            return None
    return None


def _is_type(lexemes: list[re.Match[str]]) -> bool:
    return any((m["word"] or "").lower() in TYPES for m in lexemes)


def _signs(lexemes: list[re.Match[str]], i: int) -> list[int]:
    """Where the signs are that may assign to the name at ``i``: the one beside it, and the one after a type."""
    at = _after_brackets(lexemes, i + 1)
    if at >= len(lexemes):
        return []
    sign = lexemes[at]["sign"]
    if sign not in SIGNS:
        after = _after_type(lexemes, at) if lexemes[i]["word"] else None
        declared = i > 0 and (lexemes[i - 1]["word"] or "").lower() in DECLARES
        return [after] if after is not None and (declared or (lexemes[at]["word"] or "").lower() in TYPES or (at > i + 1 and _is_type(lexemes[at:after]))) else []
    after = _after_type(lexemes, at + 1) if sign == ":" else None
    if after is None:
        return [at]
    return [after] if _is_type(lexemes[at + 1 : after]) else [at, after]


def _padded(text: str, lexemes: list[re.Match[str]], j: int) -> int | None:
    """Where a word ends with the ``=`` that pad it: they follow at once and nothing follows them."""
    at = j + 1
    if at >= len(lexemes) or lexemes[at]["sign"] not in ("=", "==") or lexemes[at].start() != lexemes[j].end():
        return None
    end = lexemes[at].end()
    return end if end == len(text) or text[end] in " \t\r\n,;)]}\"'" else None


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int]], list[int]]]:
    """(name, literals, places of earlier assignments that it takes over) of each assignment, a literal being (text, start, end).

    Strings joined by ``+`` belong to one assignment and each is a literal of its own. A name that is taken over stands for
    its last assignment before. Literals are not copied from one assignment to the next, so this is linear in the text.
    """
    known: dict[str, int] = {}
    found: list[tuple[str, list[tuple[str, int, int]], list[int]]] = []
    lexemes = [m for m in LEX.finditer(text) if m.lastgroup != "other"]
    i = 0
    while i < len(lexemes):
        m = lexemes[i]
        if m["tag"]:
            found.append((m[3], [(m["inner"], m.start("inner"), m.end("inner"))], []))
            i += 1
            continue
        name = m["word"] or (m["string"][1:-1] if m["string"] else None)
        if not name:
            i += 1
            continue
        values: list[tuple[str, int, int]] = []
        taken: list[int] = []
        end = i + 1
        for sign in _signs(lexemes, i):
            j, more = sign + 1, True
            while more and j < len(lexemes):
                v = lexemes[j]
                padded = _padded(text, lexemes, j) if v["word"] else None
                if v["string"]:
                    values.append((v["string"][1:-1], v.start() + 1, v.end() - 1))
                elif padded is not None:
                    values.append((text[v.start() : padded], v.start(), padded))
                    j += 1
                elif v["word"] and v["word"] in known:
                    if known[v["word"]] not in taken[-1:]:
                        taken.append(known[v["word"]])
                elif v["word"] and (j + 1 >= len(lexemes) or lexemes[j + 1]["sign"] not in ("(", *SIGNS)):
                    values.append((v["word"], v.start(), v.end()))
                else:
                    break
                more = j + 1 < len(lexemes) and lexemes[j + 1]["sign"] == "+"
                j += 2
            if (values or taken) and end == i + 1:
                end = max(end, j - 1)
        if values or taken:
            found.append((name, values, taken))
            if not m["string"]:
                known[name] = len(found) - 1
        i = end
    return found


def literal_spans(text: str, least: float = MIN_SCORE) -> list[tuple[int, int, str]]:
    """Spans of literals that a sensitive name reaches with a score of ``least`` or more, each once.

    What matters of a name is its weight and whether it takes phrases. These few facts run from each assignment to those it
    takes over, last ones first, in any number of steps.
    """
    low = text.lower()
    if not any(c in text for c in "=:<") or not any(part in low for part in SPELLINGS):
        return []
    found = assignments(text)
    reached: list[set[tuple[float, bool]]] = [set() for _ in found]
    spans_found: set[tuple[int, int, str]] = set()
    for i in range(len(found) - 1, -1, -1):
        name, values, taken = found[i]
        weight = sensitivity(name)
        if weight:
            reached[i].add((weight, takes_phrases(name)))
        for j in taken:
            reached[j] |= reached[i]
        if reached[i]:
            spans_found |= {(s, e, "literal") for literal, s, e in values if any(score_by(w, p, literal) >= least for w, p in reached[i])}
    return sorted(spans_found)


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans: the patterns' and those literals that no pattern's span covers."""
    base = base_spans(text)
    extra = [x for x in literal_spans(text) if not any(s <= x[0] and x[1] <= e for s, e, _ in base)]
    return sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def masked(text: str) -> str:
    """The text with each stretch of spans, overlapping ones taken together, replaced by MASK."""
    out, at = [], 0
    reach = -1
    for start, end, _ in spans(text):
        if start >= reach:
            if reach >= 0:
                at = reach
            out += [text[at:start], MASK]
            reach = end
        else:
            reach = max(reach, end)
    return "".join([*out, text[max(at, reach, 0) :]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (long), base_sha256, spans and n_literal of each document; one row per input row.

    Spans are kind:start:end in code points, end exclusive, sorted by start and kind. Null and empty texts have none.
    Texts are read whole, one at a time. Repeated rows are scanned each; other columns are ignored.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                every = spans(text.as_py() or "")
                base = [s for s in every if s[2] != "literal"]
                kinds = Counter(s[2] for s in every)
                rows.append((kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), kinds["literal"]))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])

    columns = docs.select("doc_id", "text")
    key = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(found, f"doc_id {key}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with secrets in ``text`` masked; ``n_chars``, where there is such a column, follows the text.

    A null text stays null. Rows without secrets are unchanged.
    """
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([t and masked(t) for t in (x.as_py() for x in batch.column(at))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in docs.columns and text == "text":
        before = fresh(docs, "before")
        out = docs.withColumn(before, F.length(text)).mapInArrow(clean, docs.withColumn(before, F.length(text)).schema)
        out = out.withColumn("n_chars", F.when(F.length(text) != F.col(before), F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).drop(before)
    return out
