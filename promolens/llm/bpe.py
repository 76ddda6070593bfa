"""Byte-level BPE: encoding by backtracking from longest matches, and decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import map_rows

#: Bounds of the tables each Python worker keeps: chunks of text, and pairs of tokens.
CHUNKS, PAIRS = 400_000, 2_000_000
#: Longer chunks are not remembered.
LONG_CHUNK = 64

#: White space other than blank and line feed, by any library's count; a text that holds some is not cut at blanks.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


def read_ranks(path: str) -> bytes:
    """The vocabulary file: a base64 token and its rank a line. Read where the plan is made, and shipped to the tasks."""
    with open(path, "rb") as lines:
        return lines.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def chunks(text: str) -> list[str] | None:
    """Cut before single blanks, where the pattern always ends a piece; None if the text has other white space runs."""
    if "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " " or _OTHER_SPACE.search(text):
        return None
    return text.split(" ")


class ChunkCoder:
    """Encodes texts chunk by chunk and remembers chunks, up to a bound. Ids come as packed unsigned 16- or 32-bit."""

    def __init__(self, encode: Callable[[str], list[int]], largest_id: int) -> None:
        self.encode, self.code = encode, "H" if largest_id < 1 << 16 else "I"
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _new(self, known: dict[str, bytes], chunk: str, text: str) -> bytes:
        packed = array(self.code, self.encode(text)).tobytes()
        if len(chunk) <= LONG_CHUNK and len(self.first) + len(self.later) < CHUNKS:
            known[chunk] = packed
        return packed

    def packed(self, text: str) -> bytes:
        cut = chunks(text)
        if cut is None:
            return array(self.code, self.encode(text)).tobytes()
        out = list(map(self.later.get, cut))
        out[0] = self.first.get(cut[0])
        if None in out:
            for k, chunk in enumerate(cut):
                if out[k] is None:
                    known, whole = (self.later, f" {chunk}") if k else (self.first, chunk)
                    out[k] = known.get(chunk) or self._new(known, chunk, whole)
        return b"".join(out)


class ByteBpe:
    """A vocabulary of byte strings with ranks.

    A sequence of tokens is the merges' result exactly if each two neighbours are, on their own. So the encoder
    takes the longest token that agrees with its left neighbour, else the next shorter one, and steps back where
    none does. A place once left in vain is never entered again, which bounds the work by the piece's length
    times the number of tokens that start at one place.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        reachable = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.merge(token) == [rank]}
        self.automaton = ahocorasick.Automaton()
        for token, rank in reachable.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.size = {rank: len(token) for token, rank in reachable.items()}
        self.shorter = {
            rank: next((reachable[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in reachable), -1)
            for token, rank in reachable.items()
        }

    def merge(self, data: bytes) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none can be joined."""
        parts = [data[k : k + 1] for k in range(len(data))]
        missing = len(self.ranks) + 1
        while len(parts) > 1:
            joined = [self.ranks.get(a + b, missing) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(joined)
            if best == missing:
                break
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def agree(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart as they are when their bytes are merged together."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.merge(self.token[left] + self.token[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        end = len(data)
        longest = [-1] * end
        for last, (rank, length) in self.automaton.iter(data.decode("latin-1")):
            longest[last - length + 1] = rank  # longer matches of a start end later
        dead = bytearray(end + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < end:
            while token >= 0:
                to = at + self.size[token]
                if not dead[to] and (not out or self.agree(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = to
                token = longest[at] if at < end else -1
            else:
                dead[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                token = out.pop()
                at -= self.size[token]
                token = self.shorter[token]
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pattern.findall(text):
            out += self.encode_piece(piece.encode())
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(content: bytes, pattern: str) -> tuple[ByteBpe, ChunkCoder]:
    bpe = ByteBpe(parse_ranks(content), pattern)
    return bpe, ChunkCoder(bpe.encode, max(bpe.token, default=0))


def encode_documents(docs: DataFrame, content: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode it again: the key, ids as an array, and the decoded bytes.

    A null text counts as empty: no ids, no bytes. Rows are independent, so repeated rows, null keys and further
    columns do no harm; an empty table gives no rows.
    """
    return _mapped(docs, content, pattern, key, text, f"`{key}` long, ids array<int>, decoded binary", lambda ids, decoded: (ids, decoded))


def token_digests(docs: DataFrame, content: bytes, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Like ``encode_documents``, with the ids' number and both results' SHA-256 in place of the results."""

    def digest(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
        decimals = ",".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _mapped(docs, content, pattern, key, text, f"`{key}` long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _mapped(docs: DataFrame, content: bytes, pattern: str, key: str, text: str, schema: str, result: Callable) -> DataFrame:
    vocabulary = docs.sparkSession.sparkContext.broadcast(content)  # a file of about a megabyte

    def make() -> Callable:
        bpe, chunked = coder(vocabulary.value, pattern)

        def work(keys: list, texts: list) -> list[list]:
            rows = []
            for value in texts:
                ids = array(chunked.code)
                ids.frombytes(chunked.packed(value))
                ids = ids.tolist()
                rows.append(result(ids, bpe.decode(ids)))
            return [keys, *map(list, zip(*rows, strict=True))]

        return work

    return map_rows(docs.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))), schema, make)
