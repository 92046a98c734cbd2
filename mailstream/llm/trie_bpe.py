"""BPE encoding and decoding by prefix-sharing trie traversal.

In a BPE whose merges build on earlier ones, a sequence of tokens is an
encoding exactly when each neighbouring pair is (the pair's own text encodes
to those two tokens). So an encoding is known from the last token of each of
its prefixes: the last token of ``prefix + symbol`` is the one token that ends
there and follows the last token of the prefix it leaves. Distinct words are
put in a trie; a depth-first walk carries the last-token states of the path
from the root, so a prefix that many words share is worked out once. Sorted
words are that trie in depth-first order, so the walk needs no nodes, only the
path: memory is the longest word.

Normalisation and the split into words follow the vocabulary file; texts
beyond Latin letters go through the library's own normaliser and splitter.
No shuffle: encoding is a narrow map.

Defined cases: null and empty texts have no tokens; special tokens written in
a text are encoded as such, as the library does; repeated rows give repeated
results; extra columns are ignored (kept by ``encode_documents``).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import map_rows

VOCABULARY = "word_bpe_49k.json"

#: Word encodings kept by a task before the store is emptied and refilled.
KEPT_WORDS = 400_000
#: Token pairs whose compatibility a task remembers.
MAX_PAIRS = 1_000_000
#: Documents whose new words share one trie.
TRIE_DOCS = 2048

# Fixed values of the vocabulary: the contractions of its word pattern, and
# the word-end mark.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
END = "</w>"

# A text of characters below this, also when lower-cased, needs only that
# before the word pattern, and the pattern's letters and numbers can be listed.
_PLAIN_LIMIT = 0x250


def _listed(category: str) -> str:
    return "".join(f"\\u{c:04x}" for c in range(_PLAIN_LIMIT) if unicodedata.category(chr(c))[0] == category)


def _plain() -> str:
    """Characters below the limit that stay below it when lower-cased."""
    return "".join(f"\\u{c:04x}" for c in range(_PLAIN_LIMIT) if all(ord(x) < _PLAIN_LIMIT for x in chr(c).lower()))


def plain_words() -> re.Pattern:
    """The vocabulary's word pattern for plain texts: contractions, letter
    runs, single numbers, runs of other signs."""
    letter, number = _listed("L"), _listed("N")
    return re.compile(rf"{CONTRACTIONS}|[{letter}]+|[{number}]|[^\t-\r \x85\xa0{letter}{number}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself when printable, else the
    next unused code point from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = [""] * 256, 256
    for b in keep:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b], n = chr(n), n + 1
    return out


class TrieEncoder:
    """Encodes words with a vocabulary file whose words end in ``</w>``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # a word's last letter is a symbol of its own, written as one private character
        self.last = {c: chr(0xE000 + i) for i, c in enumerate(self.letters)}
        self.rank = {(self._own(a), self._own(b)): r for r, (a, b) in enumerate(pairs)}
        self.ids = {self._own(t): i for t, i in vocab.items()}
        self.ids = {t: i for t, i in self.ids.items() if len(t) == 1 or self.merge(t) == [t]}
        # lengths of the tokens that end in two given symbols, longest first
        ends: dict[str, set[int]] = {}
        for t in self.ids:
            if len(t) > 1:
                ends.setdefault(t[-2:], set()).add(len(t))
        self.ends = {e: sorted(n, reverse=True) for e, n in ends.items()}
        self.follows: dict[tuple[str, str], bool] = {}

    def _own(self, token: str) -> str:
        if token.endswith(END):
            body = token[:-len(END)]
            return body[:-1] + self.last[body[-1]]
        return token

    def merge(self, symbols: str) -> list[str]:
        """Plain BPE of a short string, by lowest rank first."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _fits(self, a: str, b: str) -> bool:
        """Whether the text of two tokens encodes to just them."""
        ok = self.follows.get((a, b))
        if ok is None:
            if len(self.follows) > MAX_PAIRS:
                self.follows.clear()
            ok = self.follows[(a, b)] = self.merge(a + b) == [a, b]
        return ok

    def symbols(self, word: bytes) -> str:
        s = "".join([self.letters[b] for b in word])
        return s[:-1] + self.last[s[-1]]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of each distinct (normalised) word."""
        own = sorted((self.symbols(w.encode("utf-8")), w) for w in words)
        out: dict[str, list[int]] = {}
        path = ""                    # symbols from the root to the current node
        state: list[str] = []        # last token at each depth of the path
        ids, ends, fits = self.ids, self.ends, self._fits
        for s, w in own:
            shared = 0
            for x, y in zip(path, s):
                if x != y:
                    break
                shared += 1
            del state[shared:]
            # exactly one token can come last, so the likely ones go first:
            # the last token grown by the symbol, then the symbol alone
            for depth in range(shared + 1, len(s) + 1):
                token = symbol = s[depth - 1]
                if depth > 1:
                    grown = state[-1] + symbol
                    for token in (grown, symbol):
                        if token in ids and ((depth == len(token)) or fits(state[depth - len(token) - 1], token)):
                            break
                    else:
                        for n in ends.get(s[depth - 2:depth], ()):
                            token = s[depth - n:depth]
                            if n <= depth and token in ids and (n == depth or fits(state[depth - n - 1], token)):
                                break
                state.append(token)
            path = s
            tokens, depth = [], len(s)
            while depth:
                token = state[depth - 1]
                tokens.append(ids[token])
                depth -= len(token)
            out[w] = tokens[::-1]
        return out


class TextEncoder:
    """Whole texts: special tokens, normalisation, words, encodings. Of each
    word it keeps its ids and its tokens as text, ready to be joined."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.trie = TrieEncoder(path)
        self.words = plain_words()
        self.beyond = re.compile(f"[^{_plain()}]")
        self.marks = re.compile("(" + "|".join(map(re.escape, self.trie.special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.back = {c: b for b, c in enumerate(self.trie.letters)}
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}

    def _split(self, text: str) -> list[str]:
        if not self.beyond.search(text):
            return self.words.findall(text.lower())
        norm = self.library.normalizer.normalize_str(text)
        return [bytes(self.back[c] for c in p).decode("utf-8")
                for p, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; special tokens stand for themselves."""
        if "<|" not in text:
            return self._split(text)
        out = []
        for part in self.marks.split(text):
            out.extend([part] if part in self.trie.special else self._split(part) if part else [])
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text its ids and its decoded text; the vocabulary has no
        decoder, so decoding joins tokens by spaces."""
        split = [self.pieces(t) for t in texts]
        new = set().union(*split).difference(self.ids)
        if len(self.ids) + len(new) > KEPT_WORDS:
            self.ids.clear()
            self.tokens.clear()
            new = set().union(*split)
        coded = self.trie.encode_words(w for w in new if w not in self.trie.special)
        coded |= {w: [self.trie.special[w]] for w in new if w in self.trie.special}
        names = self.trie.names
        for w, ids in coded.items():
            self.ids[w] = " ".join(map(str, ids))
            self.tokens[w] = " ".join([names[i] for i in ids])
        return [(" ".join(map(self.ids.__getitem__, words)), " ".join(map(self.tokens.__getitem__, words)))
                for words in split]


_loaded: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = TextEncoder(path)
    return _loaded[path]


_ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
                         T.StructField("decoded", T.StringType())])
_DIGEST = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def _rows(docs: DataFrame, schema: T.StructType, path: str | None, make) -> DataFrame:
    where = path or default_path()

    def rows(batch):
        enc = text_encoder(where)
        for r, (ids, decoded) in zip(batch, enc.encode_batch([r["text"] or "" for r in batch])):
            yield {"doc_id": r["doc_id"]} | make(ids, decoded)

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, rows, TRIE_DOCS)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every text."""
    return _rows(docs, _ENCODED, path, lambda ids, decoded: {"ids": [int(i) for i in ids.split()], "decoded": decoded})


def _sha(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def op6_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digests of ids and decoded text of every document."""
    return _rows(docs, _DIGEST, path, lambda ids, decoded: {
        "n_tokens": len(ids.split()), "ids_sha256": _sha(ids), "decoded_sha256": _sha(decoded)})
