"""A byte-level tokenizers file as a fast function from text to ids."""

from __future__ import annotations

import json
from array import array

import regex
import tiktoken
from tokenizers import Tokenizer

#: Words that an encoder keeps with their ids before the memory is emptied again.
REMEMBERED = 400_000
#: Fixed: the split pattern of byte-level vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with other characters are split by the library itself.
COMMON = r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ‐-‧€]"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves,
    the others for the letters from U+0100 on, in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    other = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + other.index(b)) for b in range(256)]


class ByteLevelEncoder:
    """ids(text): the library's ids as little-endian bytes, ``width`` bytes an id.

    Where the file's ids rise with its merges, its vocabulary is a list of ranks, and texts
    of common characters are encoded by rank, which gives the same ids several times faster.
    A text with a special token's string in it, or with other characters, goes to the
    tokenizers library.
    """

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        special = [regex.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.odd = regex.compile("|".join([COMMON, *special])).search
        model = json.loads(spec)["model"]
        made = [model["vocab"]["".join(m.split(" ", 1) if isinstance(m, str) else m)] for m in model["merges"]]
        self.by_rank = None
        if made == sorted(set(made)) and made[0] >= 256:
            back = {c: b for b, c in enumerate(byte_letters())}
            ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items()}
            self.by_rank = tiktoken.Encoding("by_rank", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if self.by_rank is None or self.odd(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.by_rank(text)
        return array("H" if self.width == 2 else "I", ids).tobytes()
