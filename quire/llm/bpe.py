"""BPE encoding and decoding by a prefix-sharing trie.

Distinct words of a batch go into a trie.  A depth-first walk gives every node the last token of its prefix's encoding:
the longest vocabulary entry that ends there and whose pairing with the last token of the remaining prefix is stable
under the merge order.  A word's encoding is read off by following last tokens backwards, so prefixes that many words
share are worked out once.  Word ends ("</w>") make the final symbol of a word an edge of its own.

Defined results: null or empty text gives no tokens and an empty decoded text; special-token strings inside a text are
encoded as those tokens (as the library does by default); rows repeat as they come; other columns of the input are
ignored unless asked for with `keep`.
"""

from __future__ import annotations

import hashlib
import gc
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct words whose encodings a worker keeps; the cache is emptied when it is full.
CACHE_WORDS = 400_000
#: Distance of the signs for final symbols from those for inner ones; byte letters are below it.
FINAL = 0x400
#: Characters of text that share one trie.
GROUP_CHARS = 2_000_000


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others are shifted above U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class TrieBpe:
    """Encoder and decoder for a `tokenizers` JSON file with BPE over byte letters and a word-end suffix."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names: dict[int, str] = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.letters = {i: c for i, c in enumerate(letters)}
        self.packed = {i: struct.pack("<I", i) for i in self.names}
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        # the same pattern for lower-case ASCII, where the classes are plain ranges
        self.ascii_words = re.compile(pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            t = self.vocab[a + b]
            pair = (self.vocab[a], self.vocab[b])
            self.rank[pair] = r
            if t not in self.made:
                self.made[t], self.halves[t] = r, pair
        # Token spellings with one sign for each symbol: a word's final symbol is shifted to a range of its own.
        self.spelled = {self.spelling(t): i for t, i in self.vocab.items()}
        self.heads = {t[:n] for t in self.spelled for n in range(1, len(t) + 1)}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
        self.stable_pairs: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.cache_words = cache_words

    def normal(self, text: str) -> str:
        """NFC, white space runs to a space, lower case letter by letter (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def _stable(self, one: int, two: int) -> bool:
        """Whether two tokens side by side stay as they are: undo merges, latest first, and look for an earlier join across the border."""
        rank, made, halves = self.rank.get, self.made.get, self.halves
        limit = 1 << 60
        while True:
            joined = rank((one, two))
            if joined is not None and joined < limit:
                return False
            a, b = made(one, -1), made(two, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # the left token was finished last: before that, its right half stood at the border
                limit, one = a, halves[one][1]
            else:  # equal merges run left to right, so a join of the same rank across the border comes first
                limit, two = b + 1, halves[two][0]

    def spelling(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token.removesuffix(self.suffix)
            return token[:-1] + chr(ord(token[-1]) + FINAL)
        return token

    def step(self, state: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """For a head of some token and a further symbol: the longest ending that is again a head, and the tokens that end here, longest first."""
        whole = state
        while state not in self.heads:
            state = state[1:]
        found = [(self.spelled[state[i:]], len(state) - i) for i in range(len(state)) if state[i:] in self.spelled]
        out = self.steps[whole] = state, tuple((t, n) for t, n in found if n == 1 or self.own(t))
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words through one trie and keep the results."""
        table, root = self.letters, {}
        for w in words:
            path = w.encode().decode("latin-1").translate(table)
            node = root
            for symbol in path[:-1]:
                below = node.get(symbol)
                if below is None:
                    below = node[symbol] = {}
                node = below
            symbol = chr(ord(path[-1]) + FINAL) if self.suffix else path[-1]
            node.setdefault(symbol, {})[""] = w
        steps, step, pairs, stable, cache = self.steps, self.step, self.stable_pairs, self._stable, self.cache
        pack, names = self.packed, self.names
        ids: list[int] = [-1]  # by depth on the current path: last token, its length, state of the suffix search
        size: list[int] = [0]
        todo = [(1, "", symbol, node) for symbol, node in root.items()]
        while todo:
            depth, state, symbol, node = todo.pop()
            del ids[depth:], size[depth:]
            head = state + symbol
            state, found = steps.get(head) or step(head)
            for token, n in found:
                if n == depth:
                    break
                pair = (ids[depth - n], token)
                good = pairs.get(pair)
                if good is None:
                    good = pairs[pair] = stable(*pair)
                if good:
                    break
            ids.append(token)
            size.append(n)
            for symbol, below in node.items():
                if symbol:
                    todo.append((depth + 1, state, symbol, below))
                else:
                    at, out = depth, []
                    while at:
                        out.append(ids[at])
                        at -= size[at]
                    out.reverse()
                    cache[below] = (b"".join([pack[i] for i in out]), " ".join([names[i] for i in out]))

    def own(self, token: int) -> bool:
        """Whether a token is what its own letters encode to: both halves must be, and must not be parted by an earlier merge."""
        known = self.stable_pairs.get((token, -1))
        if known is None:
            half = self.halves.get(token)
            if half is None:
                known = True
            else:
                known = self.own(half[0]) and self.own(half[1]) and self._stable_below(half, self.made[token])
            self.stable_pairs[token, -1] = known
        return known

    def _stable_below(self, pair: tuple[int, int], limit: int) -> bool:
        """As _stable, but only merges before `limit` count."""
        held = self.rank.pop(pair)
        ok = self._stable(*pair) if held == limit else False
        self.rank[pair] = held
        return ok

    def parts(self, text: str | None) -> list[list[str] | str]:
        """A text as lists of words and the special tokens between them."""
        if not text:
            return []
        out: list[list[str] | str] = []
        for i, part in enumerate(self.cut.split(text) if self.cut and "<|" in text else [text]):
            if i % 2:
                out.append(part)
            else:
                part = self.normal(part)
                out.append((self.ascii_words if part.isascii() else self.words)(part))
        return out

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and the decoded text.  The texts share one trie."""
        split = [self.parts(x) for x in texts]
        self.prepare()
        cache, held = self.cache, gc.isenabled()
        new = {w for x in split for words in x if isinstance(words, list) for w in set(words).difference(cache)}
        gc.disable()  # the trie is large and holds no cycles
        self.learn(new)
        if held:
            gc.enable()
        for x in split:
            if len(x) == 1 and isinstance(x[0], list):
                got = [cache[w] for w in x[0]]
            else:
                got = [g for words in x for g in ([cache[w] for w in words] if isinstance(words, list) else [(self.packed[self.special[words]], words)])]
            yield b"".join([g[0] for g in got]), " ".join([g[1] for g in got])

    def encode_all_in_groups(self, column: pa.Array) -> Iterator[tuple[bytes, str]]:
        """encode_all over groups of up to GROUP_CHARS characters (or one text), so that what is held stays bounded."""
        group, size = [], 0
        for value in column:
            text = value.as_py()
            if group and size + len(text or "") > GROUP_CHARS:
                yield from self.encode_all(group)
                group, size = [], 0
            group.append(text)
            size += len(text or "")
        yield from self.encode_all(group)

    def encode_parts(self, text: str | None) -> tuple[bytes, str]:
        return next(iter(self.encode_all([text])))

    def prepare(self) -> None:
        """Called between batches: empties what has grown over its bound."""
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        if len(self.stable_pairs) > 4 * self.cache_words:
            self.stable_pairs.clear()
        if len(self.steps) > self.cache_words:
            self.steps.clear()

    def encode(self, text: str | None) -> list[int]:
        raw = self.encode_parts(text)[0]
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieBpe:
    """One encoder for each worker process and vocabulary."""
    return TrieBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", digests_only: bool = False) -> DataFrame:
    """key, ids array<int>, decoded string for every row; with digests_only their SHA-256 and the count instead.

    The vocabulary file is opened on the executors, so `path` must be readable on each of them."""
    kind = docs.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests_only else "ids array<bigint>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            n, a, b = [], [], []
            for ids, decoded in bpe.encode_all_in_groups(batch.column(1)):
                n.append(len(ids) // 4)
                if digests_only:
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(decoded.encode()).hexdigest())
                else:
                    a.append(list(struct.unpack(f"<{len(ids) // 4}I", ids)))
                    b.append(decoded)
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] if digests_only else [key, "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string() if digests_only else pa.list_(pa.int64())), pa.array(b, pa.string())], names=names)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
