"""Token ids of texts by a public tokenizer file, with a memory of the pieces seen."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces kept in a worker's memory (about 130 bytes each) before it starts anew; it never changes a result.
MEMORY = 1_000_000

#: A chunk that is one run of letters in the middle and runs of signs around it. The file's rule splits such a chunk at these
#: places; an apostrophe may begin a contraction and is left out. The letters have no other composed or lower-case form.
TAIL = b".,;:!?*$%&#|"
SIMPLE = re.compile("([!-&(-/:-;=?-@[-`{}~]*)([a-zß-öø-ÿ]+)([!-&(-/:-;=?-@[-`{}~]*)")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder(dict):
    """Chunks (words between ASCII white space) to numbers; ids of a number are in a table.

    White space never joins pieces, so a text's ids are those of its chunks. A chunk is encoded once while it is remembered.
    Only ASCII chunks are put in lower case here, and none of a text that holds a special token in other letters: the
    tokenizer composes before it lower-cases, and looks for special tokens before both.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = '"Lowercase"' in self.tokenizer.to_str()[:4000]
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.folded = [s.lower() for s in self.special]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat = array("I")  # ids of all numbers in a row
        self.ends = array("q", [0])  # where those of each number end; the first entry is where number 0 begins

    def __missing__(self, chunk: bytes) -> int:
        core = chunk.rstrip(TAIL)
        if core.isalpha() and (low := chunk.lower()) != chunk:  # a word of a text with other than ASCII characters
            ids = self._known(low)
        elif core.isalpha():  # ASCII letters
            ids = self._letters(core.decode()) if core is chunk or core == chunk else self._known(core) + self._known(chunk[len(core) :])
        else:
            ids = self._chunk(chunk.decode("utf-8", "replace"))
        return self._remember(chunk, ids)

    def _remember(self, key: bytes, ids: list[int]) -> int:
        number = self[key] = len(self.ends) - 1
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        return number

    def _known(self, chunk: bytes) -> list[int]:
        number = self[chunk]
        return self.flat[self.ends[number] : self.ends[number + 1]].tolist()

    def _letters(self, run: str) -> list[int]:
        return [t.id for t in self.model.tokenize(run)]

    def _chunk(self, chunk: str) -> list[int]:
        if m := SIMPLE.fullmatch(chunk):
            return [i for run in m.groups() if run for i in self._letters(run if run.isascii() else run.encode().decode("latin-1").translate(_byte_letters()))]
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _literal(self, token: int) -> int:
        """The number of an id by itself, remembered under a key that no chunk has."""
        key = b" %d" % token
        return dict.get(self, key, -1) if key in self else self._remember(key, [token])

    def encode(self, texts: list[bytes], end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole UTF-8 texts in a row, the end id after each, and the number of each text's ids, the end id included."""
        if len(self) > MEMORY:
            self.forget()
        last = np.array([] if end is None else [self._literal(end)], np.int64)
        parts: list[np.ndarray] = []
        for text in texts:
            if any(s in text for s in self.special) or not self.plain:
                found = map(self._literal, self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
                parts += [np.fromiter(found, np.int64), last]
            else:
                low = text.lower()
                chunks = (low if text.isascii() and not any(s in low for s in self.folded) else text).split()
                parts += [np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks)), last]
        counts = np.fromiter(map(len, parts), np.int64, len(parts)).reshape(-1, 2).sum(1)
        numbers = np.concatenate(parts) if parts else last[:0]
        # these views end with the call: an array that is viewed cannot grow
        flat, ends = np.frombuffer(self.flat, np.uint32), np.frombuffer(self.ends, np.int64)
        begins = ends[numbers]
        sizes = ends[numbers + 1] - begins
        upto = np.concatenate([[0], np.cumsum(sizes)])
        kind = np.int32 if max(len(flat), upto[-1]) < 1 << 31 else np.int64
        at = np.repeat((begins - upto[:-1]).astype(kind), sizes)
        at += np.arange(upto[-1], dtype=kind)
        ids = flat[at]
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])


def slices(texts: Iterable[bytes | None], most: int = 1 << 22) -> Iterator[list[bytes]]:
    """Texts in lists of about ``most`` bytes; null counts as empty, a longer text is alone with what came before it."""
    part: list[bytes] = []
    size = 0
    for text in texts:
        part.append(text or b"")
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder for a worker process and tokenizer file."""
    return Encoder(path)
