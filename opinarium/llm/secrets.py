"""Secrets in texts: three plain patterns, and strings that compress badly where secrets stand.

A candidate is a long string shortly after a word that names something secret. Its novelty is what
it adds to the compressed size of nothing, with zstandard primed by a dictionary of common
identifiers and by the text around the candidate, over its own length. Identifiers are found in the
dictionary and add little; keys add about their length. Strings that mostly read like words and short
numbers, as paths do, are no candidates. Parts that points join to a reported candidate belong to it
if they are long and novel themselves. Copies of the
candidate are taken out of the text around it, so a repeated key is found at each of its places. A
reported candidate goes on over the lines of a key block that directly follow.

Null and empty texts have no spans. Whole texts are searched. Positions are code points. Rows keep
their order, may repeat, and keep every column in ``redacted``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped, Block, blocks, byte_class, kept_in_worker, spans

# Kinds in order, and their patterns.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS, _ACCESS_LEAST = r"AKIA[A-Z0-9]+", 20
_HEX_LEAST, _ASSIGN_LEAST = 24, 6
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# The method's own: what makes a context sensitive, what a candidate looks like.
_CONTEXT_WORDS = (b"password", b"passwd", b"passphrase", b"secret", b"token", b"apikey", b"api_key", b"api-key",
                  b"credential", b"private_key", b"private key", b"access_key", b"access key", b"bearer ",
                  b"authorization", b"auth_key", b"client_id", b"signature=")
LEAST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
# Lines of a key block; in strings of programs and JSON, line breaks are written out.
_BREAK = r"(?:\r?\n|(?:\\r)?\\n)"
_NEXT_LINE = re.compile(rf"[ \t]*{_BREAK}[ \t]*([A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}})(?=[ \t\"',;]*(?:[\r\n\\]|\Z))")
_LAST_LINE = re.compile(rf"[ \t]*{_BREAK}[ \t]*([A-Za-z0-9+/_-]{{1,{LEAST - 1}}}"
                        rf"(?:={{1,2}}(?=[ \t\"',;]*(?:[\r\n\\]|\Z))|(?=[ \t]*{_BREAK}[ \t]*-----END)))")
#: A dot and what may go on behind it.
_JOINED = re.compile(rf"\.([A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}})")
_PART = re.compile(r"(?<![A-Za-z0-9])(?:[a-z]{1,3}|[0-9]{1,4})(?![A-Za-z0-9])|[A-Z]?[a-z]{3,}|[A-Z]{4,}")
_UNSPOKEN = re.compile(r"[^aeiouy]{4}", re.IGNORECASE)
#: Least share of vowels in a word.
VOWELS = 0.2
#: A candidate with a larger share of words and short numbers is none.
READABLE = 0.8
#: A candidate begins at most so many characters behind a context word.
CONTEXT_REACH = 48
#: So many characters before and behind a candidate prime the compressor.
SURROUNDING = 2048
#: Least share of its length that a reported candidate adds.
NOVELTY = 0.6
MARK = "[secret]"

_IDENTIFIERS = " ".join("""
authorization authentication password passwd passphrase username credentials access_token refresh_token
client_secret client_id private_key public_key access_key secret_key api_key session_id signature certificate
configuration environment application controller repository connection transaction description information
development production localhost example placeholder your_token_here changeme undefined function return import
export default package version public static private protected interface implementation abstract response request
headers content-type application/json https://www.example.com http://localhost:8080 /usr/local/bin /home/user
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 00000000000000000000 xxxxxxxxxxxxxxxxxxxx
-------------------- ____________________ ==================== aaaaaaaaaaaaaaaaaaaa ffffffffffffffffffff
""".split()).encode()

_HEX = byte_class((0x30, 0x39), (0x61, 0x66))


def _patterns():
    return re.compile(_ASSIGN, re.ASCII | re.IGNORECASE), re.compile(_ACCESS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the plain patterns."""
    assign, access = kept_in_worker("secret patterns", _patterns)
    found = [(m.start(), m.end(), 0) for m in assign.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    found += [(m.start(), m.end(), 1) for m in access.finditer(text) if len(m[0]) >= _ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in re.finditer(f"[0-9a-f]{{{_HEX_LEAST},}}", text)]
    return sorted(found)


def _added(candidate: bytes, around: bytes) -> int:
    """Bytes that the candidate adds behind the dictionary and the text around it."""
    primer = zstandard.ZstdCompressionDict(_IDENTIFIERS + b"\n" + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=9, dict_data=primer, write_content_size=False, write_checksum=False,
                                     write_dict_id=False)
    return len(press.compress(candidate)) - len(press.compress(b""))


def novel_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the candidates that add much."""
    found, context = [], kept_in_worker("secret context", lambda: re.compile(
        "|".join(re.escape(w.decode()) for w in _CONTEXT_WORDS), re.ASCII | re.IGNORECASE))
    ends = np.array([m.end() for m in context.finditer(text)])
    if not len(ends):
        return found
    done = 0
    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        at = np.searchsorted(ends, start, side="right") - 1
        if start < done or at < 0 or start - ends[at] > CONTEXT_REACH or _readable(match[0]):
            continue
        if _novel(text, start, end):
            while (part := _JOINED.match(text, end)) and _novel(text, *part.span(1)):
                end = part.end(1)
            done = _end_of_block(text, end)
            found.append((start, done, 3))
    return found


def _novel(text: str, start: int, end: int) -> bool:
    candidate = text[start:end]
    return _added(candidate.encode(), _around(text, start, end).encode()) >= NOVELTY * len(candidate)


def _readable(candidate: str) -> bool:
    """Whether most letters and digits of a candidate are in words or short numbers."""
    read = sum(len(m[0]) for m in _PART.finditer(candidate) if m[0].isdigit() or len(m[0]) <= 3 or _spoken(m[0]))
    return read > READABLE * sum(c.isalnum() for c in candidate)


def _spoken(letters: str) -> bool:
    return sum(c in "aeiouyAEIOUY" for c in letters) >= VOWELS * len(letters) and not _UNSPOKEN.search(letters)


def _around(text: str, start: int, end: int) -> str:
    """The text before and behind a candidate, without what repeats ``LEAST`` characters of it."""
    runs = {text[i:i + LEAST] for i in range(start, end - LEAST + 1)}
    parts = []
    for low, high in ((max(0, start - SURROUNDING), start), (end, min(len(text), end + SURROUNDING))):
        # A copy may begin before the surrounding text or end behind it.
        first, last = (max(0, low - LEAST + 1), high) if high == start else (low, min(len(text), high + LEAST - 1))
        at = low
        for i in range(first, last - LEAST + 1):
            if text[i:i + LEAST] in runs:
                parts += [text[at:max(at, min(i, high))], "\n"]
                at = max(at, i + LEAST)
        parts += [text[at:max(at, high)], "\n"]
    return "".join(parts)


def _end_of_block(text: str, end: int) -> int:
    """Where the key block ends whose line ends at ``end``: directly following lines belong to it
    that are candidates and add much, and a short last one."""
    while (line := _NEXT_LINE.match(text, end)) and _novel(text, *line.span(1)):
        end = line.end(1)
    last = _LAST_LINE.match(text, end)
    return last.end(1) if last else end


def _suspects(block: Block) -> np.ndarray:
    """Rows that may hold a span: those with a word of the patterns or contexts, or a long hex run."""
    lowered = block.lowered()
    places = []
    for words, data in (({*_ASSIGN_WORDS, *_CONTEXT_WORDS}, lowered.data.tobytes()), ((b"AKIA",), block.data.tobytes())):
        for word in words:
            at = data.find(word)
            while at >= 0:
                places.append(at)
                at = data.find(word, at + len(word))
    starts, ends = spans(block.data, _HEX)
    places.extend(starts[ends - starts >= _HEX_LEAST].tolist())
    return np.unique(block.rows_of(np.array(places, dtype=np.int64)))


def found_in(block: Block) -> dict[int, tuple[str, list, list]]:
    """Per row with spans: its text, the plain spans and the added ones."""
    found = {}
    for row in _suspects(block).tolist():
        text = block.text(row).decode()
        base, novel = base_spans(text), novel_spans(text)
        if base or novel:
            found[row] = (text, base, novel)
    return found


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(found, key=lambda s: (s[0], s[2], s[1])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans."""
    schema = T.StructType([docs.schema["doc_id"]])
    for name in ("n_assign", "n_access", "n_hex", "n_novel"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_sha256", T.StringType()).add("spans", T.StringType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = found_in(block)
                rows = [found.get(i, ("", [], [])) for i in range(len(block))]
                counts = [[sum(s[2] == k for s in base + novel) for _, base, novel in rows] for k in range(4)]
                digests = [hashlib.sha256(_listed(base).encode()).hexdigest() for _, base, _ in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(block.first, len(block)),
                    *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                    pa.array([_listed(base + novel) for _, base, novel in rows], pa.string())], schema.names)

    return mapped(docs.select("doc_id", "text"), run, schema)


def _masked(text: str, found: list[tuple[int, int, int]]) -> str:
    parts, at = [], 0
    for start, end, _ in sorted(found):
        if start >= at:
            parts += [text[at:start], MARK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by a mark, and ``n_chars``, if there, counted anew
    where a text changed."""
    counts = "n_chars" in docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first, len(block))
                changed = {i: _masked(t, base + novel) for i, (t, base, novel) in sorted(found_in(block).items())}
                if changed:
                    mask = np.isin(np.arange(len(part)), list(changed))
                    part = _replaced(part, "text", mask, list(changed.values()))
                    if counts:
                        part = _replaced(part, "n_chars", mask, [len(t) for t in changed.values()])
                yield part

    return mapped(docs, run, docs.schema)


def _replaced(batch: pa.RecordBatch, name: str, mask: np.ndarray, values: list) -> pa.RecordBatch:
    place = batch.schema.get_field_index(name)
    column = pa.concat_arrays([batch.column(place)])  # without the offset of a slice
    column = pc.replace_with_mask(column, pa.array(mask), pa.array(values, column.type))
    return batch.set_column(place, batch.schema.field(place), column)
