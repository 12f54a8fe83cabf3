"""Assignment-aware secret scan (operator 8).

Base patterns find spelled-out secrets. On top of them a small lexer reads
source and configuration syntax (name = literal, name: literal, "name":
literal, NAME=literal, export / const / let / var prefixes, typed
declarations, subscript targets, literals added to literals, #define, setenv
and ENV lines, authorization headers, XML attributes and elements) into
name-literal pairs, carries literals through names assigned to names, and
scores each literal by how sensitive its target's name is.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from personalens.llm.common import binary_texts, pick, read_table, small_batches

# Fixed patterns of the base kinds, in the order that breaks ties.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ with 32+ characters
ASSIGN_MIN, ACCESS_MIN = 8, 16
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")

# A name counts by its parts, split at case changes, digits and separators.
NAME_SCORE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "credential": 3, "credentials": 3,
              "token": 2, "apikey": 3, "auth": 2, "authorization": 3, "bearer": 2, "private": 2, "access": 1, "key": 1, "api": 1,
              "client": 1, "session": 1, "signing": 1, "encryption": 1, "salt": 1, "dsn": 1}
#: A literal is reported from this score on; its length is at least MIN_LITERAL. With white space its name must score SURE_NAME.
MIN_SCORE, MIN_LITERAL, SURE_NAME = 3.0, 8, 3
#: A quoted value goes to its own closing quote, over escaped characters, at any length,
#: or, if an escape runs off the line, without regard to escapes.
#: A backtick literal and a triple-quoted one may hold line ends, others only escaped ones or, for PEM blocks, their own.
ONE_QUOTED = r"""
      "(?P<double>(?:-----BEGIN\x20[^"\\]*+(?:\\.[^"\\]*+)*+|[^"\\\n]*+(?:\\.[^"\\\n]*+)*+))"
      |'(?P<single>(?:-----BEGIN\x20[^'\\]*+(?:\\.[^'\\]*+)*+|[^'\\\n]*+(?:\\.[^'\\\n]*+)*+))'
      |"(?P<raw2>[^"\n]*+)"|'(?P<raw1>[^'\n]*+)'
"""
VALUE = rf"""
    (?:(?P<tq>\"{{3}}|'{{3}})(?P<triple>(?:[^\\"']++|\\.|(?!(?P=tq))["'])*+)(?P=tq)
      |{ONE_QUOTED}
      |`(?P<back>[^`\\]*+(?:\\.[^`\\]*+)*+)`
      |(?P<bare>[^\s"'`,;(){{}}\[\]]++))
"""
LEXER = re.VERBOSE | re.ASCII | re.DOTALL
#: Name and assignment. The name may be a subscript's, and a second word beside it (its type, or the name after a type) counts as a name too.
PAIR = re.compile(rf"""
    (?<![\w.$-])(?:(?:export|const|let|var|final|static|set)[\x20\t]+)*
    (?P<nq>["']?)(?P<name>[A-Za-z_][\w.-]*+)(?P=nq)
    (?:[\x20\t]*+\])?+
    (?:(?:[\x20\t]*+:[\x20\t]*+|[\x20\t]++)(?P<second>[A-Za-z_][\w.]*+)(?:<[^<>=\n]*+>|\[[^\[\]=\n]*+\])?+[\x20\t]*+=(?![=>])
      |[\x20\t]*+(?::=|=>|=|:))
    [\x20\t]*+(?:\(\s*+(?=["'`]))?+
    {VALUE}
    """, LEXER)
#: What may follow a quoted literal to make it longer: another one beside it, or added to it.
MORE = re.compile(rf"""(?:[\x20\t]*+|\s*+(?:\+|\.\.?|&|\\\r?\n)\s*+)(?:{ONE_QUOTED})""", LEXER)
#: Lines that name and value share without a sign between them.
DIRECTIVE = re.compile(rf"""
    (?:^|(?<=[;&|]))[\x20\t]*+(?:(?P<define>\#[\x20\t]*+define)|setenv|set(?:[\x20\t]+-\w+)*+|ENV|ARG)
    [\x20\t]++(?P<name>[A-Za-z_][\w.-]*+)[\x20\t]++(?![=:])(?:\(\s*+(?=["'`]))?+
    {VALUE}
    """, LEXER | re.MULTILINE)
LINE_END = re.compile(r"[\x20\t]*+(?:\Z|[\r\n;&|])")
HEADER = re.compile(r"""(?<![\w-])(?P<name>(?:Proxy-)?Authorization)[\x20\t]*+[:=][\x20\t]*+
    (?:Bearer|Basic|Token|Digest|ApiKey|Negotiate)[\x20\t]++(?P<bare>[^\s"'`,;(){}\[\]]++)""", re.VERBOSE | re.ASCII | re.IGNORECASE)
#: An element's name and value attributes in either order, or its name and its text. Attributes between the two are
#: of other names, so no part of a text is read for two pairs.
_ATTRIBUTES = r"""(?:(?!%s[\s=])[\w:.-]++\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+')\s*+)*+"""
_NAME_IS = r"""(?:name|key|id)\s*+=\s*+(?P<%s>["'])(?P<%s>[\w.:-]++)(?P=%s)\s*+"""
_VALUE_IS = r"""value\s*+=\s*+(?:"(?P<%s>[^"<]*+)"|'(?P<%s>[^'<]*+)')\s*+"""
XML_NAMES = (
    re.compile(rf"""(?<![\w:.-]){_NAME_IS % ("q", "name", "q")}{_ATTRIBUTES % "(?:name|key|id|value)"}{_VALUE_IS % ("double", "single")}""", re.ASCII),
    re.compile(rf"""(?<![\w:.-]){_VALUE_IS % ("double", "single")}{_ATTRIBUTES % "(?:name|key|id|value)"}{_NAME_IS % ("q", "name", "q")}""", re.ASCII),
    re.compile(rf"""<[\w:.-]++\s++{_NAME_IS % ("q", "name", "q")}[^<>"'/]*+>\s*+(?P<bare>[^\s<>]++)\s*+</""", re.ASCII),
    re.compile(r"""<(?P<name>[A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?+>\s*+(?P<bare>[^\s<>]++)\s*+</(?P=name)\s*+>""", re.ASCII),
)
QUOTED = ("triple", "double", "single", "raw2", "raw1", "back")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
SPACE = re.compile(r"\s")
NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9.]*\Z", re.ASCII)
PLACEHOLDER = re.compile(r"(?i)\A(?:x+|\*+|\.+|<.*>|\$\{.*|%\(.*|null|none|true|false|undefined)\Z")
#: Words of a placeholder, alone or followed by a separator or another known word; a literal that looks random is none.
PLACEHOLDER_WORDS = re.compile(r"""(?xis)\A(?:your|my|the|some|example|sample|dummy|change)
    (?:[\W_].*|(?:me|this|it|that|here|value|key|token|secret|password|passwd|passphrase|pwd|pass|api|access|private|user|name|string|text|data|\d+)(?:[\W_\d].*|[a-z]*))?\Z""")
RANDOM_LOOK = 2.75


def is_placeholder(value: str) -> bool:
    return bool(PLACEHOLDER.match(value) or PLACEHOLDER_WORDS.match(value) and literal_score(value) < RANDOM_LOOK)


def name_score(name: str) -> int:
    parts = [p.lower() for p in PART.findall(name)]
    return sum(NAME_SCORE.get(p, 0) for p in dict.fromkeys(parts))


def literal_score(value: str) -> float:
    """How random the literal looks: bits a character, with a bonus for mixed kinds of characters."""
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.isdigit, str.islower, str.isupper))
    return entropy / 2 + (kinds - 1) / 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, leftmost and non-overlapping within a kind."""
    found = [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _value(m: re.Match) -> str:
    """The name of the group that holds the match's value."""
    groups = m.groupdict()
    return next((g for g in QUOTED if groups.get(g) is not None), "bare")


def _longer(text: str, value: str, end: int) -> tuple[str, int]:
    """A quoted value and its end, with the literals that are added to it."""
    parts = [value]
    while text[end:end + 1] in ("\"", "'") and (m := MORE.match(text, end + 1)):
        parts.append(m[_value(m)])
        end = m.end(_value(m))
    return "".join(parts), end


def _assigned(text: str) -> Iterator[tuple[str, str, int, int, str]]:
    at = 0
    while m := PAIR.search(text, at):
        group = _value(m)
        value, start, end = m[group], m.start(group), m.end(group)
        at = m.end()
        if group != "bare":
            kind = "quoted"
            if group in ("double", "single"):
                value, end = _longer(text, value, end)
                at = max(at, end + 1)
            # What spans lines or holds escapes may be no literal after all: pairs inside it count as well.
            if "\n" in m[group] or "\\" in m[group]:
                at = start
        else:
            # NAME=word, alone on its line: an unquoted setting.
            kind = "line" if m.end("name") + 1 == start and text[end:end + 1] in ("", "\n", "\r") \
                and not text[text.rfind("\n", max(0, m.start() - 200), m.start()) + 1:m.start()].strip() else "bare"
            if value.endswith(":") and value.count(":") == 1:  # "note: name: literal"
                at = start
        for name in filter(None, (m["name"], m["second"])):
            yield name, value, start, end, kind


def _directives(text: str) -> Iterator[tuple[str, str, int, int, str]]:
    for m in DIRECTIVE.finditer(text):
        group = _value(m)
        value, end = m[group], m.end(group)
        if group in ("double", "single"):
            value, end = _longer(text, value, end)
        if group != "bare":
            kind = "quoted"
        elif m["define"]:
            kind = "bare"
        elif LINE_END.match(text, end):
            kind = "line"
        else:
            continue
        yield m["name"], value, m.start(group), end, kind


def _headers(text: str) -> Iterator[tuple[str, str, int, int, str]]:
    """Credentials of authorization headers; letters alone must be of mixed case, or they are prose."""
    for m in HEADER.finditer(text):
        yield m["name"], m["bare"], *m.span("bare"), "quoted" if m["bare"][1:] != m["bare"][1:].lower() else "bare"


def _marked_up(text: str) -> Iterator[tuple[str, str, int, int, str]]:
    for pattern in XML_NAMES:
        for m in pattern.finditer(text):
            group = _value(m)
            yield m["name"], m[group], m.start(group), m.end(group), "quoted"


def name_literal_pairs(text: str) -> list[tuple[str, str, int, int, str]]:
    """(name, value, start, end, kind) of every assignment, by start; kind is quoted, line (all of a line's value) or bare.

    A value of literals added to each other is their whole, from the first's start to the last's end.
    """
    found = []
    if "=" in text or ":" in text:
        found.append(_assigned(text))
        found.append(_headers(text))
    if any(w in text for w in ("define", "set", "ENV", "ARG")):
        found.append(_directives(text))
    if "<" in text:
        found.append(_marked_up(text))
    return sorted(chain(*found), key=lambda p: p[2])


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals that reach a sensitive name, directly or through other names.

    A bare value that is a name assigned before stands for that name's
    literal (the last assignment before it). The literal where it is written
    gets the score of the most sensitive name it reaches. An unquoted word of
    letters alone counts only as all of a line's value, under a sure name.
    """
    origin: dict[str, tuple[int, int]] = {}
    best: dict[tuple[int, int], int] = {}
    values: dict[tuple[int, int], str] = {}
    for name, value, start, end, kind in name_literal_pairs(text):
        score = name_score(name)
        if kind != "quoted" and NAME.match(value) and value in origin:
            span = origin[value]
        elif len(value) >= MIN_LITERAL and (kind == "quoted" or not value.isalpha()
                                            or kind == "line" and score >= SURE_NAME and not name_score(value)):
            span = (start, end)
            values[span] = value
        else:
            origin.pop(name, None)
            continue
        origin[name] = span
        if score:
            best[span] = max(best.get(span, 0), score)
    out = []
    for (start, end), score in best.items():
        value = values[start, end]
        if score >= 2 and not is_placeholder(value) and (score >= SURE_NAME or not SPACE.search(value)) \
                and score + literal_score(value) >= MIN_SCORE + 1:
            out.append((start, end, "literal"))
    return sorted(out)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans: the method's are added where no base span covers them."""
    base = base_spans(text)
    extra = [s for s in literal_spans(text) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        rows = []
        for raw in binary_texts(batch.column("text")):
            base, spans = scan(raw.decode())
            n = Counter(k for _, _, k in base)
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_scan(docs: DataFrame) -> DataFrame:
    """Spans of secrets (code points, end exclusive) of every whole text, one row per input row.

    Null and empty texts have no spans; repeated rows are scanned each;
    an empty table gives an empty result. No shuffle.
    """
    return pick(docs).mapInArrow(_scan_batches, SCHEMA)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with the union of all spans' secret part replaced by the mark."""
    out, at = [], 0
    for start, end, _ in scan(text)[1]:
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join(out) + text[at:] if out else text


def _redacted(text_col: str, size_col: str | None):
    """Batches with their secrets replaced; a few texts at a time, as a worker holds both the old and the new ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            new = [t and redact(t) for t in texts]
            arrays = dict(zip(batch.schema.names, batch.columns, strict=True))
            arrays[text_col] = pa.array(new, batch.schema.field(text_col).type)
            if size_col in arrays:
                sizes = batch.column(size_col).to_pylist()
                sizes = [n if a == b else len(b) for a, b, n in zip(texts, new, sizes, strict=True)]
                arrays[size_col] = pa.array(sizes, batch.schema.field(size_col).type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), schema=batch.schema)
    return run


def redact_secrets(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All columns of docs, secrets replaced in text_col; size_col (if given) is set to the new length where a text changed.

    Clean, null and empty texts are kept as they are.
    """
    return docs.mapInArrow(_redacted(text_col, size_col), docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents"))
