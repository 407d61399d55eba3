"""Secret scans: base patterns, and an assignment-aware lexer for source and configuration text.

The lexer reads statements that bind a name to a value: ``name = value`` with any of the
usual operators, JSON and YAML pairs, exports and declarations, element text in markup, and calls
such as ``set("name", "value")``. A value is a chain of string literals and names joined by
``+``, ``.`` or ``..``, or one bare literal. Names whose value is known are put in where they
are used (constants are propagated in the order of the text), so a secret that is first stored under a
harmless name is found once a sensitive name takes it over. Every name-literal pair is scored:
how sensitive the name is, times how much the literal looks like key material.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from opsmart.llm.common import map_texts

#: Fixed patterns of the base kinds; a match counts if its measured part is long enough.
_ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "literal")
_HEX_BYTES = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_HEX_RUN = b"\x01" * _HEX_LEAST

#: Words of a name and how sensitive they make it (1: it names a secret).
_NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "secrets": 1.0,
    "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "jwt": 0.9,
    "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0, "pass": 0.8, "auth": 0.7,
    "signature": 0.6, "salt": 0.6, "pin": 0.6, "otp": 0.7, "dsn": 0.6,
}
#: Words that make ``key`` sensitive when they stand before it.
_KEY_OF = {"api", "access", "private", "secret", "auth", "account", "encryption", "signing", "master", "session", "client", "storage"}
#: Literals that stand in for a secret.
_PLACEHOLDER = re.compile(
    r"^(?:x+|\*+|\.+|-+|0+|1234\d*|none|null|nil|true|false|undefined|todo|changeme|change_me|example\w*|dummy\w*"
    r"|placeholder|redacted|secret|password|token|test\w*|your[-_ ].*|my[-_ ].*|<.*|\$\{.*|\{\{.*|%\(.*|%\w+%|\$\w+"
    r"|os\.environ.*|getenv.*|env\..*|process\.env.*)$",
    re.IGNORECASE,
)
#: Of any length: a name is read from one place only, as is an element, whose parts hold no "<".
_NAME = r"[A-Za-z_][A-Za-z0-9_\-]*(?:\.[A-Za-z_][A-Za-z0-9_\-]*)*"
_STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
_BARE = r"[A-Za-z0-9+/_.=\-$~@!%^&*]+"
_BINDING = re.compile(
    rf"(?<![\w.\-])(?:(?P<q>[\"'`])(?P<quoted>{_NAME})(?P=q)|(?P<name>{_NAME}))"
    rf"(?:\[[\"']?(?P<item>[\w\-]+)[\"']?\])?\x20*(?::\x20*[A-Za-z_][\w.]{{0,40}}\x20*=|:=|=>|\?=|\+=|->|=|:)(?!=)[\x20\t]*"
)
_PART = re.compile(rf"(?P<string>{_STRING})|(?P<bare>{_BARE})")
_JOIN = re.compile(r"[\x20\t]*(?:\+|\.\.?)[\x20\t]*(?=[\"'`A-Za-z_])")
_ELEMENT = re.compile(rf"<(?P<name>{_NAME})(?:\s[^<>\n]*)?>(?P<value>[^<>\n]{{4,}})</(?P=name)>")
_CALL = re.compile(rf"\(\s{{0,8}}(?P<q>[\"'])(?P<name>{_NAME})(?P=q)\s{{0,8}},\s{{0,8}}(?P<value>{_STRING})")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: Longer chains are known by their parts and not written out, else "a = a + a" would grow without bound.
_WRITTEN_OUT = 4096
#: Characters at the start of a chain in which a stand-in for a secret shows.
_HEAD = 64
#: A pair is reported from this score on.
THRESHOLD = 0.5


@dataclass(frozen=True)
class Span:
    """``kind`` at ``start:end`` (code points, end exclusive); ``value`` is the part that is secret."""

    start: int
    end: int
    kind: str
    value: tuple[int, int]


@dataclass(frozen=True, eq=False)
class Chain:
    """What scoring needs of a text that is not written out."""

    #: Characters without white space, as a number that may be too large for an index, and the share of each.
    size: float
    shares: dict[str, float]
    #: The first characters, and which others there are.
    head: str
    rest: frozenset[str]
    #: White space at the start, at the end, and between other characters.
    before: bool
    after: bool
    inside: bool

    @staticmethod
    def of(text: str) -> Chain:
        core = text.strip()
        counts = Counter("".join(core.split()))
        size = sum(counts.values())
        bare = text.lstrip()
        return Chain(
            size, {c: n / size for c, n in counts.items()}, bare[:_HEAD], frozenset(bare[_HEAD:].strip()),
            text[:1].isspace(), text[-1:].isspace(), any(c.isspace() for c in core),
        )

    def then(self, other: Chain) -> Chain:
        if not (self.size and other.size):
            one = self if self.size else other
            return Chain(
                one.size, one.shares, one.head, one.rest, self.before or (not self.size and other.before),
                other.after or (not other.size and (self.after or other.before)), one.inside,
            )
        size = self.size + other.size
        shares = {c: x * (self.size / size) for c, x in self.shares.items()}
        for c, x in other.shares.items():
            shares[c] = shares.get(c, 0.0) + x * (other.size / size)
        head = self.head + other.head if self.size < _HEAD else self.head
        rest = self.rest | other.rest | frozenset(head[_HEAD:] if self.size < _HEAD else other.head)
        inside = self.inside or other.inside or self.after or other.before
        return Chain(min(size, 1e300), shares, head[:_HEAD], rest, self.before, other.after, inside)


@dataclass(frozen=True, eq=False)
class Literal:
    """A value: its text or, of a long chain, what scoring needs; where it stands, or the values it is made of."""

    text: str | None
    places: tuple[tuple[int, int], ...]
    quoted: bool
    parts: tuple[Literal, ...] = ()
    chain: Chain | None = None

    @staticmethod
    def joined(parts: list[Literal]) -> Literal:
        if len(parts) == 1:
            return parts[0]
        quoted = any(p.quoted for p in parts)
        if all(p.text is not None for p in parts) and sum(len(p.text) for p in parts) <= _WRITTEN_OUT:
            return Literal("".join(p.text for p in parts), (), quoted, tuple(parts))
        chain = reduce(Chain.then, (p.chain or Chain.of(p.text) for p in parts))
        return Literal(None, (), quoted, tuple(parts), chain)


def places(literals: list[Literal]) -> set[tuple[int, int]]:
    """Where the literals and all that they are made of stand; each is looked at once."""
    found: set[tuple[int, int]] = set()
    seen: set[int] = set()
    left = list(literals)
    while left:
        literal = left.pop()
        if id(literal) not in seen:
            seen.add(id(literal))
            found.update(literal.places)
            left += literal.parts
    return found


def base_spans(text: str) -> list[Span]:
    """Matches of the three base kinds that are long enough."""
    found = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= _ASSIGN_LEAST:
                found.append(Span(*m.span(), "assign", m.span(2)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= _ACCESS_LEAST:
                found.append(Span(*m.span(), "access", m.span()))
    if _HEX_RUN in text.encode().translate(_HEX_BYTES):
        for m in _HEX.finditer(text):
            if m.end() - m.start() >= _HEX_LEAST:
                found.append(Span(*m.span(), "hex", m.span()))
    return found


def name_sensitivity(name: str) -> float:
    """How surely a value of this name is a secret, from the words it is made of."""
    words = [w.lower() for part in re.split(r"[^A-Za-z0-9]+", name) for w in _CAMEL.findall(part)]
    whole = "".join(words)
    best = max((_NAME_WEIGHTS.get(w, 0.0) for w in [*words, whole]), default=0.0)
    for before, word in zip(words, words[1:], strict=False):
        if word in ("key", "keys") and before in _KEY_OF:
            best = 1.0
        best = max(best, _NAME_WEIGHTS.get(before + word, 0.0))
    # A name that tells where or how a secret is kept is not the secret.
    if words and words[-1] in {"file", "path", "name", "url", "type", "id", "length", "size", "count", "field", "hint", "policy"}:
        best *= 0.3
    return best


def literal_quality(literal: Literal) -> float:
    """How much a literal looks like key material: its length, variety and kinds of characters."""
    if literal.text is None:
        return _chain_quality(literal)
    text = literal.text.strip()
    if len(text) < 6 or _PLACEHOLDER.match(text) or any(c.isspace() for c in text):
        return 0.0
    if not literal.quoted and not any(c.isdigit() for c in text):
        return 0.0  # a bare word is more likely a name or prose
    counts = Counter(text)
    entropy = -sum(n / len(text) * math.log2(n / len(text)) for n in counts.values())
    kinds = sum(any(test(c) for c in text) for test in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in text)
    return min(1.0, 0.25 * min(len(text) / 12, 1) + 0.5 * min(entropy / 3.2, 1) + 0.1 * kinds)


def _chain_quality(literal: Literal) -> float:
    """The same for a long chain that is not written out."""
    chain = literal.chain
    if chain.size < 6 or chain.inside or _PLACEHOLDER.match(chain.head + "".join(sorted(chain.rest))):
        return 0.0
    if not literal.quoted and not any(c.isdigit() for c in chain.shares):
        return 0.0
    entropy = -sum(x * math.log2(x) for x in chain.shares.values() if x)
    kinds = sum(any(test(c) for c in chain.shares) for test in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in chain.shares)
    return min(1.0, 0.25 * min(chain.size / 12, 1) + 0.5 * min(entropy / 3.2, 1) + 0.1 * kinds)


def _value(text: str, at: int, known: dict[str, Literal]) -> tuple[Literal | None, int]:
    """The literal that starts at ``at``, with known names put in."""
    parts: list[Literal] = []
    while m := _PART.match(text, at):
        if m["string"] is not None:
            parts.append(Literal(m["string"][1:-1], ((m.start() + 1, m.end() - 1),), True))
        else:
            bare = m["bare"].rstrip(".,")
            constant = known.get(bare) or known.get(bare.rpartition(".")[2])
            if constant is not None:
                parts.append(constant)
            elif parts:
                break  # an unknown name: the literals so far are what is known
            else:
                parts.append(Literal(bare, ((m.start(), m.start() + len(bare)),), False))
        at = m.end()
        if not (join := _JOIN.match(text, at)):
            break
        at = join.end()
    return (Literal.joined(parts) if parts else None), at


def pairs(text: str) -> list[tuple[str, Literal]]:
    """Name-literal pairs in the order of the text."""
    known: dict[str, Literal] = {}
    found: list[tuple[int, str, Literal]] = []
    if "=" in text or ":" in text or "->" in text:
        at = 0
        while m := _BINDING.search(text, at):
            name = m["quoted"] or m["name"]
            if m["item"]:
                name = f"{name}.{m['item']}"
            literal, end = _value(text, m.end(), known)
            if literal is not None:
                known[name] = literal
                known.setdefault(name.rpartition(".")[2], literal)
                found.append((m.start(), name, literal))
            at = m.end()  # a value may itself begin a binding, as in "a: b = c"
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            found.append((m.start(), m["name"], Literal(m["value"], (m.span("value"),), True)))
    if "," in text and ('("' in text or "('" in text or '( "' in text):
        for m in _CALL.finditer(text):
            a, b = m.span("value")
            found.append((m.start(), m["name"], Literal(text[a + 1 : b - 1], ((a + 1, b - 1),), True)))
    return [(name, literal) for _, name, literal in sorted(found, key=lambda x: x[0])]


def lexed_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Where the literals of sensitive pairs stand."""
    secret = []
    for name, literal in pairs(text):
        weight = name_sensitivity(name)
        if weight and weight * literal_quality(literal) >= threshold:
            secret.append(literal)
    return [Span(a, b, "literal", (a, b)) for a, b in places(secret) if b > a]


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, ordered by start and kind."""
    text = text or ""
    base = base_spans(text)
    order = lambda s: (s.start, KINDS.index(s.kind), s.end)
    return sorted(base, key=order), sorted(base + lexed_spans(text), key=order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``.

    A null text counts as empty: no spans, and the digest of an empty list. Rows are scanned by
    themselves; repeated rows give repeated results and an empty table an empty one.
    """

    def worker():
        def score(texts: list) -> dict:
            out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for t in texts:
                base, every = scan(t)
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(s.kind == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(every))
            return out

        return score

    counts = [StructField(f"n_{kind}", LongType()) for kind in KINDS[:3]]
    return map_texts(docs, worker, [*counts, StructField("base_sha256", StringType()), StructField("spans", StringType())])


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every secret value replaced; a text without one stays as it is."""
    if not text:
        return text
    values = sorted(s.value for s in scan(text)[1])
    if not values:
        return text
    out, at, reach = [], 0, -1
    for a, b in values:
        if a >= reach:
            out += [text[at:a], mark]
        reach = max(reach, b)
        at = reach
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, with the secrets in ``text`` replaced.

    ``n_chars``, where it is there, follows the text. Null and empty texts stay as they are.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    names = docs.columns
    at = names.index("text")
    counted = names.index("n_chars") if "n_chars" in names else None
    arrow = to_arrow_schema(docs.schema)

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [redact_text(t) for t in old]
            columns[at] = pa.array(new, type=arrow.field(at).type)
            if counted is not None:
                sizes = columns[counted].to_pylist()
                sizes = [n if a is b or a == b else len(b) for n, a, b in zip(sizes, old, new, strict=True)]
                columns[counted] = pa.array(sizes, type=arrow.field(counted).type)
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

    return docs.mapInArrow(run, docs.schema)
