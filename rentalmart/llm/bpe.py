"""BPE encoding and decoding as bounded-lookahead transducers.

Merging is usually done over a whole word. Whether two neighbouring tokens stay apart,
though, depends on a bounded number of symbols to their right only, and that number follows
from the merge list. The encoder reads symbols into a short buffer, merges inside it, and
emits a token as soon as at least that many symbols lie behind it; so even a word of
millions of letters needs constant memory. The decoder turns ids into bytes and bytes into
text one by one, keeping only an unfinished character.

Why the lookahead suffices. A merge (a, b) of rank i can be prevented from the right only if
b, or a symbol on b's right edge before b is complete, is first merged with what follows by
a rule (s, y) of lower rank j; whether that happens depends on what follows y through rules
of yet lower rank. So reach(i) = max over such j of len(y) + reach(j), with falling ranks,
and the largest len(y) + reach(j) over all rules bounds how far a boundary can depend on
what comes after it. A boundary that never merges splits the word into independent halves.
"""

from __future__ import annotations

import codecs
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import regex
from tokenizers import Tokenizer

from .encoders import COMMON, REMEMBERED, byte_letters

LONGEST_REMEMBERED = 48  # symbols of a word that is worth remembering
WORDS = 4096  # words, or ids, that are handled at a time
SHORT = 1 << 16  # characters of a text whose words are found at once


def lookahead(merges: list[tuple[str, str]], size=len) -> int:
    """Symbols behind a token that decide whether it is final, for a ranked merge list."""
    right = {a + b: b for a, b in reversed(merges)}
    reach: dict[str, int] = {}  # by left symbol, over the rules so far
    most = 0
    for a, b in merges:
        edge, far = b, 0
        while edge is not None:
            far = max(far, reach.get(edge, 0))
            edge = right.get(edge)
        far += size(b)
        reach[a] = max(reach.get(a, 0), far)
        most = max(most, far)
    return most


class Encoder:
    """Text to ids for a tokenizers file of kind BPE whose pre-tokenizer is a split pattern
    followed by byte letters.

    ``pieces`` streams a text's ids, ``ids`` gives all of them, ``word`` streams one word. The
    library is asked only how to normalise and split texts with characters outside the common
    ones, which it does to the whole text.
    """

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: k for k, m in enumerate(merges)}
        length = lambda s: len(s[: -len(self.end)] if self.end and s.endswith(self.end) else s)
        self.ahead = lookahead(merges, length)
        self.longest = max(map(length, self.vocab))
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        steps = [s for s in parsed["pre_tokenizer"].get("pretokenizers", [parsed["pre_tokenizer"]]) if s["type"] == "Split"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"])
        self.odd = regex.compile(COMMON).search
        self.library = Tokenizer.from_str(spec)
        self.known: dict[str, bytes] = {}

    def _merge(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, lowest rank first and from the left."""
        symbols, rank, none = symbols[:], self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            symbols[k] += symbols.pop(k + 1)
            del ranks[k]
            if k:
                ranks[k - 1] = rank((symbols[k - 1], symbols[k]), none)
            if k < len(ranks):
                ranks[k] = rank((symbols[k], symbols[k + 1]), none)
        return symbols

    def word(self, letters: Iterable[str]) -> Iterator[int]:
        """Ids of one word given as byte letters, emitted as soon as they are final."""
        buffer: list[str] = []  # single letters
        full = 2 * (self.longest + self.ahead)
        for letter in letters:
            if len(buffer) >= full:
                done, limit = 0, len(buffer) - self.ahead
                for token in self._merge(buffer):
                    if done + len(token) > limit:
                        break
                    yield self.vocab[token]
                    done += len(token)
                del buffer[:done]
            buffer.append(letter)
        if buffer:
            buffer[-1] += self.end
            for token in self._merge(buffer):
                yield self.vocab[token]

    def _words(self, text: str) -> Iterable[str]:
        """The words of a text without special tokens, as byte letters."""
        if not self.odd(text):
            lower = text.lower()
            words = self.split.findall(lower) if len(lower) <= SHORT else (m[0] for m in self.split.finditer(lower))
            if text.isascii():
                return words
            letters = self.letters
            return (w if w.isascii() else "".join([letters[b] for b in w.encode()]) for w in words)
        if not text:
            return ()
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return (w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal))

    def _plain(self, text: str) -> Iterator[bytes]:
        """Ids of WORDS words at a time; those of a long word as they come."""
        known, words = self.known, iter(self._words(text))
        while some := [*islice(words, WORDS)]:
            try:
                yield b"".join([known[w] for w in some])
                continue
            except KeyError:
                pass
            out: list[bytes] = []
            for w in some:
                ids = known.get(w)
                if ids is None and len(w) <= LONGEST_REMEMBERED:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = ids = array("I", self.word(w)).tobytes()
                if ids is not None:
                    out.append(ids)
                    continue
                yield b"".join(out)
                out, stream = [], self.word(w)
                while piece := array("I", islice(stream, WORDS)):
                    yield piece.tobytes()
            yield b"".join(out)

    def pieces(self, text: str) -> Iterator[bytes]:
        """The text's ids as little-endian unsigned 32-bit numbers, a bounded number at a time."""
        if not any(s in text for s in self.special):
            yield from self._plain(text)
            return
        at = 0
        for found in self.specials.finditer(text):
            yield from self._plain(text[at:found.start()])
            yield self.special[found[0]].to_bytes(4, "little")
            at = found.end()
        yield from self._plain(text[at:])

    def packed(self, text: str) -> bytes:
        """All ids of the text, as ``pieces`` gives them."""
        return b"".join(self.pieces(text))

    def ids(self, text: str) -> list[int]:
        return array("I", self.packed(text)).tolist()


class Decoder:
    """Ids to text: a state machine over bytes that keeps an unfinished character only.

    With a byte-level decoder in the file, tokens are runs of byte letters; without any
    decoder the library writes the tokens themselves with a space between, and so does this.
    Bytes that are no UTF-8 become U+FFFD.
    """

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        back = {c: b for b, c in enumerate(byte_letters())}
        raw = bool(parsed.get("decoder"))
        self.between = b"" if raw else b" "
        self.bytes = {i: bytes(back[c] for c in t) if raw else t.encode() for t, i in parsed["model"]["vocab"].items()}
        self.bytes |= {t["id"]: t["content"].encode() for t in parsed["added_tokens"]}

    def start(self) -> Decoding:
        return Decoding(self)

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ``ids`` piece by piece."""
        state = self.start()
        for i in ids:
            if i in self.bytes:  # the library leaves out what is no id
                yield state.feed((i,))
        yield state.end()

    def text(self, ids: Iterable[int]) -> str:
        table = self.bytes
        return self.between.join([table[i] for i in ids if i in table]).decode("utf-8", "replace")


class Decoding:
    """The state between ids: the bytes of an unfinished character, and whether any id came."""

    def __init__(self, decoder: Decoder):
        self.table, self.between, self.first = decoder.bytes, decoder.between, True
        self.to_text = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int]) -> str:
        """The text that some more ids finish."""
        table = self.table
        try:
            found = [*map(table.__getitem__, ids)]
        except KeyError:  # the library leaves out what is no id
            found = [table[i] for i in ids if i in table]
        if not found:
            return ""
        if not self.first and self.between:
            found.insert(0, b"")
        self.first = False
        return self.to_text.decode(self.between.join(found))

    def end(self) -> str:
        return self.to_text.decode(b"", final=True)
