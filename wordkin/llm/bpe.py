"""BPE encoding and decoding of whole texts as streams.

The encoder is a transducer over the symbols of a word. For every prefix it knows the last token of the
prefix's encoding, which is unique: a token that is an encoding of itself and may follow the last token of
the shorter prefix. The encoding of a longer word passes through the end of one of the last ``lookahead`` prefixes,
``lookahead`` being the longest token of the merge list, so tokens on which these prefixes agree are stable
and are emitted. A text is read in slices that end at white space.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import ship_package

#: characters that a slice of a long text has at least
SLICE_CHARS = 1 << 16
#: words whose encoding a task remembers, and the longest such word
CACHE_WORDS = 300_000
CACHED_LENGTH = 64

# fixed values: the white space that the tokenizer's patterns know, and its mark of a word's end
_WHITE = "\t-\r \x85\xa0  -     　"
_GAP = re.compile(f"[{_WHITE}]")
_END = "</w>"


# fixed value: the tokenizer's pattern of words, once for any text and once, faster, for texts in Latin-1
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{white}{letter}{number}]+"


def _latin(kind: str) -> str:
    return "".join(rf"\x{code:02x}" for code in range(256) if unicodedata.category(chr(code))[0] == kind)


_LATIN_WORDS = re.compile(_PATTERN.format(letter=_latin("L"), number=_latin("N"), white=_WHITE[:6]))


@functools.lru_cache(maxsize=1)
def character_classes() -> tuple[str, str]:
    """The letters and the numbers, as ranges in a character class.

    Which these are changes with the version of Unicode, so the tokenizers library is asked for its own: what is left of all
    characters when it takes them out. The driver asks once and sends the answer along, so all tasks cut words alike.
    """
    from tokenizers import Regex, normalizers

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = []
    for kind in "LN":
        others = set(normalizers.Replace(Regex(rf"\p{{{kind}}}"), "").normalize_str(every))
        codes = np.array([ord(c) for c in every if c not in others])
        starts = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
        ends = np.concatenate([starts[1:], [len(codes)]]) - 1
        found.append("".join(f"\\U{codes[i]:08x}-\\U{codes[j]:08x}" for i, j in zip(starts, ends, strict=True)))
    return found[0], found[1]


@functools.lru_cache(maxsize=1)
def _normal_form():
    from tokenizers import normalizers

    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


class WordCutter:
    """Cuts a text into words, in normal form and lower case."""

    def __init__(self, classes: tuple[str, str]):
        self._any = re.compile(_PATTERN.format(letter=classes[0], number=classes[1], white=_WHITE))

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._any.findall(_normal_form().normalize_str(text))
        # such a text is in normal form
        return _LATIN_WORDS.findall(text.lower())


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordBpe:
    """A tokenizer file with merges over byte letters, lower-cased words and a mark at the end of a word."""

    def __init__(self, path: str, classes: tuple[str, str] | None = None):
        self._cut = WordCutter(classes or character_classes())
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("end_of_word_suffix") != _END:
            raise ValueError("not a tokenizer with word ends")
        vocab: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.names = {i: t for t, i in (vocab | self.special).items()}
        self.joins_tokens = spec.get("decoder") is None
        letters = _byte_letters()
        self._letters = {i: c for i, c in enumerate(letters)}
        self.byte_of = {c: i for i, c in enumerate(letters)}
        #: symbols that the transducer has to look ahead at most
        self.lookahead = max(len(t.removesuffix(_END)) for t in vocab)
        self._spines: tuple[dict, dict] = ({}, {})
        self._follows: dict[tuple[str, str], bool] = {}
        self._cache: dict[str, bytes] = {}
        self._last: dict[str, str] = {}
        # tokens that the merges do build
        self.vocab = {t: i for t, i in vocab.items() if self._merge(self._symbols(t)) == [t]}
        #: each of them once: what is remembered shares these strings
        self._tokens = {t: t for t in self.vocab}

    def _merge(self, symbols: list[str]) -> list[str]:
        """The merge list applied to a short span, lowest rank first."""
        while len(symbols) > 1:
            rank = min(self.ranks.get(pair, len(self.ranks)) for pair in zip(symbols, symbols[1:], strict=False))
            if rank == len(self.ranks):
                break
            symbols = self._merge_once(symbols, rank)
        return symbols

    def _merge_once(self, symbols: list[str], rank: int) -> list[str]:
        out, i = [], 0
        while i < len(symbols):
            if i + 1 < len(symbols) and self.ranks.get((symbols[i], symbols[i + 1])) == rank:
                out.append(symbols[i] + symbols[i + 1])
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        return out

    @staticmethod
    def _symbols(token: str) -> list[str]:
        return [*token[:-len(_END) - 1], token[-len(_END) - 1:]] if token.endswith(_END) and len(token) > len(_END) else list(token)

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The symbols at a token's left (0) or right (1) edge while it is built, each with the rank that ends it."""
        known = self._spines[side].get(token)
        if known is None:
            # merging the token's own symbols, one merge after the other
            symbols, steps = self._symbols(token), []
            edge = -side
            while len(symbols) > 1:
                rank = min(self.ranks.get(pair, len(self.ranks)) for pair in zip(symbols, symbols[1:], strict=False))
                before = symbols[edge]
                symbols = self._merge_once(symbols, rank)
                if symbols[edge] != before:
                    steps.append((before, rank))
            known = self._spines[side][token] = [*steps, (token, len(self.ranks))]
        return known

    def _may_follow(self, left: str, right: str) -> bool:
        """No merge crosses the border: at no time do the two symbols at it merge before one merges inwards."""
        known = self._follows.get((left, right))
        if known is None:
            ends, begins, i, j, known = self._spine(left, 1), self._spine(right, 0), 0, 0, True
            while True:
                (a, a_until), (b, b_until) = ends[i], begins[j]
                rank = self.ranks.get((a, b))
                # of equal pairs the leftmost merges first
                if rank is not None and rank < a_until and rank <= b_until:
                    known = False
                    break
                if i + 1 == len(ends) and j + 1 == len(begins):
                    break
                if a_until <= b_until:
                    i += 1
                else:
                    j += 1
            if len(self._follows) >= CACHE_WORDS:
                self._follows.clear()
            self._follows[left, right] = known
        return known

    def stream_word(self, letters: str, emit_every: int = 256) -> Iterator[int]:
        """Ids of one word of byte letters, each as soon as no later letter can change it."""
        known, reach, follows = self._tokens.get, self.lookahead, self._follows
        # of each prefix that is still open: its last token and where that begins
        last: dict[int, tuple[str, int]] = {0: ("", 0)}
        done, n = 0, len(letters)
        for end in range(1, n + 1):
            tail = _END if end == n else ""
            for begin in range(max(done, end - reach), end):
                token = known(letters[begin:end] + tail)
                if token is None:
                    continue
                if begin:
                    pair = (last[begin][0], token)
                    fits = follows.get(pair)
                    if not (self._may_follow(*pair) if fits is None else fits):
                        continue
                last[end] = (token, begin)
                break
            if end < n and end % emit_every == 0:
                # the boundaries that the paths to all of the last prefixes share
                shared: set[int] | None = None
                for p in range(max(done, end - reach + 1), end + 1):
                    path = set()
                    while p > done:
                        path.add(p)
                        p = last[p][1]
                    shared = path if shared is None else shared & path
                if shared:
                    upto = max(shared)
                    yield from self._path(last, done, upto)
                    for p in [p for p in last if p < upto]:
                        del last[p]
                    done = upto
        yield from self._path(last, done, n)

    def _path(self, last: dict[int, tuple[str, int]], begin: int, end: int) -> list[int]:
        ids = []
        while end > begin:
            token, end = last[end]
            ids.append(self.vocab[token])
        return ids[::-1]

    def _last_token(self, prefix: str, letters: str) -> str:
        """The last token of the encoding of ``letters``; the encodings of shorter prefixes are remembered."""
        known, tokens, follows = self._tokens.get, self._last, self._follows
        end = len(prefix)
        for begin in range(max(0, end - self.lookahead), end):
            token = known(letters[begin:])
            if token is not None:
                if not begin:
                    return token
                left = tokens[prefix[:begin]]
                fits = follows.get((left, token))
                if self._may_follow(left, token) if fits is None else fits:
                    return token
        raise AssertionError("every letter is a token")

    def _short_word(self, letters: str) -> list[int]:
        """As ``stream_word``, for a word that is read at once: prefixes that other words had are not read again."""
        tokens, n = self._last, len(letters)
        if len(tokens) >= CACHE_WORDS:
            tokens.clear()
        known = n - 1
        while known > 0 and letters[:known] not in tokens:
            known -= 1
        for end in range(known + 1, n):
            prefix = letters[:end]
            tokens[prefix] = self._last_token(prefix, prefix)
        token = self._last_token(letters, letters + _END)
        ids, left = [self.vocab[token]], n + len(_END) - len(token)
        while left:
            token = tokens[letters[:left]]
            ids.append(self.vocab[token])
            left -= len(token)
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        """A word's ids as 32-bit integers; short words are remembered, up to ``CACHE_WORDS`` of them."""
        letters = word.encode("utf-8").decode("latin-1").translate(self._letters)
        if len(letters) > CACHED_LENGTH:
            return array("i", self.stream_word(letters)).tobytes()
        if len(self._cache) >= CACHE_WORDS:
            self._cache.clear()
        ids = self._cache[word] = array("i", self._short_word(letters)).tobytes()
        return ids

    def forget(self) -> None:
        """Let go of all that was remembered of the words read so far."""
        for held in (self._cache, self._last, self._follows, *self._spines):
            held.clear()

    def _plain(self, text: str) -> bytes:
        get, word_ids = self._cache.get, self._word
        return b"".join([get(w) or word_ids(w) for w in self._cut(text)])

    def stream_text(self, text: str) -> Iterator[bytes]:
        """Ids of a text as pieces of 32-bit integers, slice by slice."""
        begin, n = 0, len(text)
        while begin < n:
            gap = _GAP.search(text, begin + SLICE_CHARS) if n - begin > SLICE_CHARS else None
            end = gap.start() if gap else n
            part, at = text[begin:end], 0
            for found in self._special.finditer(part) if self._special and "<" in part else ():
                yield self._plain(part[at:found.start()])
                yield array("i", [self.special[found.group()]]).tobytes()
                at = found.end()
            yield self._plain(part[at:] if at else part)
            begin = end

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.stream_text(text)), np.int32)


class TextDecoder:
    """Ids to text, piece by piece; holds back a space or the bytes of an unfinished character only.

    Without a decoder in its file a tokenizer gives the tokens with spaces between them. With ``to_bytes``
    the tokens' bytes are decoded instead, a word's end being a space, and what is not UTF-8 becomes U+FFFD.
    """

    def __init__(self, bpe: WordBpe, to_bytes: bool = False):
        self._bpe, self._to_bytes, self._begun = bpe, to_bytes, False
        self._utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        names = [x for x in map(self._bpe.names.get, ids) if x is not None]
        if not self._to_bytes:
            if not names:
                return ""
            out = " ".join(names)
            out, self._begun = (" " + out if self._begun else out), True
            return out
        out = []
        for name in names:
            body, end = (name[:-len(_END)], b" ") if name.endswith(_END) else (name, b"")
            if name in self._bpe.special:
                out.append(self._utf8.decode(name.encode()))
            else:
                out.append(self._utf8.decode(bytes(self._bpe.byte_of[c] for c in body) + end))
        return "".join(out)

    def finish(self) -> str:
        return self._utf8.decode(b"", True) if self._to_bytes else ""


@functools.lru_cache(maxsize=4)
def load_bpe(path: str, classes: tuple[str, str] | None = None) -> WordBpe:
    """Loaded once per worker."""
    return WordBpe(path, classes)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies on this machine; looked up on the machine that reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, decode: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs`` (``doc_id, text``), with ``decode`` the text that the ids decode to as ``decoded``.

    Null text counts as empty and gives no ids and an empty text. Repeated rows are encoded each. A very long text is encoded slice
    by slice, whole. Extra columns are not read; an empty table has no rows. Rows are encoded where they are read: nothing is shuffled.
    ``path`` must exist on all executors; by default each finds the installed file.
    """
    ship_package(docs.sparkSession)
    classes = character_classes()
    kinds = [pa.field("ids", pa.list_(pa.int32())), *([pa.field("decoded", pa.string())] if decode else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(path or tokenizer_path(), classes)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    ids = [bpe.encode(text or "") for text in part.column(1).to_pylist()]
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    columns = [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))]
                    if decode:
                        texts = []
                        for x in ids:
                            decoder = TextDecoder(bpe)
                            texts.append(decoder.feed(x.tolist()) + decoder.finish())
                        columns.append(pa.array(texts, pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([part.schema.field(0), *kinds]))
        finally:
            # the worker goes on to other tasks, which need its memory
            bpe.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decode)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(path or tokenizer_path())
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder = TextDecoder(bpe)
                texts.append(decoder.feed(ids or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             schema=pa.schema([batch.schema.field(0), ("text", pa.string())]))

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def encode_with_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``."""
    done = encode_documents(docs, path, decode=True)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
