"""Token ids of whole texts by the tokenizers library, remembered per chunk.

Byte-level pre-tokenisation always cuts in front of a space that follows a character that is
no white space, in front of a full stop or comma that follows a letter or digit, and on both
sides of a line end between other characters. The chunks between such cuts can be encoded one
by one, and a chunk that was seen before costs one look-up. The ids are those of the library
for the whole text; texts in which such a cut could be wrong are cut less or not at all.
"""

from __future__ import annotations

import os
import re
from itertools import filterfalse, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
#: Chunks remembered by one worker; beyond that it forgets those that it met least often.
REMEMBERED = 1_000_000
_CUT = "\x01"
#: A chunk without white space but for one space in front.
_PLAIN = re.compile(r" ?\S+").fullmatch
_RUN = 200  # new chunks encoded in one go
#: By byte: 1 for ASCII white space, 2 for ASCII letters and digits.
_CLASS = bytes(1 if b in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32) else 2 * (b < 128 and chr(b).isalnum()) for b in range(256))

_loaded: dict[str, "ChunkEncoder"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1]
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.first = np.zeros(1 << 19, np.int64)
        self.length = np.zeros(1 << 19, np.int64)
        self.met = np.zeros(1 << 19, np.int64)
        self.used = 0

    def _thin(self) -> None:
        """Keep what was met in more than one call, at most half of the room; counts start anew."""
        count = len(self.codes)
        met = self.met[:count]
        least = 2
        while np.count_nonzero(met >= least) > REMEMBERED // 2:
            least += 1
        kept = np.flatnonzero(met >= least)
        names = list(self.codes)  # in the order of their codes
        first, size = self.first[kept], self.length[kept]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(first - (ends - size), size) + np.arange(int(size.sum()))]
        self._forget()
        self._grow(len(ids), len(kept))
        self.flat[: len(ids)] = ids
        self.first[: len(kept)] = ends - size
        self.length[: len(kept)] = size
        self.codes = {names[i]: code for code, i in enumerate(kept.tolist())}
        self.used = len(ids)

    def _grow(self, ids: int, chunks: int) -> None:
        while ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while chunks > len(self.first):
            for name in ("first", "length", "met"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks and give each the next code.

        Chunks without line ends are encoded in one go with line ends between them: those are
        tokens of their own there, which mark where a chunk's ids end.
        """
        code = len(self.codes)
        joined = list(filter(_PLAIN, chunks))
        chunks = joined + list(filterfalse(_PLAIN, chunks))
        parts, sizes = [], []
        runs = ["\n".join(joined[at : at + _RUN]) + "\n" for at in range(0, len(joined), _RUN)]
        for done in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False):
            ids = np.array(done.ids, np.uint32)
            ends = np.flatnonzero(ids == self.line_end)
            sizes.append(np.diff(ends, prepend=-1) - 1)
            parts.append(ids[ids != self.line_end])
        for chunk in chunks[len(joined) :]:
            parts.append(np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, np.uint32))
            sizes.append(np.array([len(parts[-1])]))
        ids, size = np.concatenate(parts), np.concatenate(sizes)
        if len(size) != len(chunks):
            raise ValueError("line ends between chunks were not kept apart by this tokenizer")
        self._grow(self.used + len(ids), code + len(chunks))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[code : code + len(chunks)] = self.used + np.cumsum(size) - size
        self.length[code : code + len(chunks)] = size
        self.codes.update(zip(chunks, range(code, code + len(chunks))))
        self.used += len(ids)

    def _marked(self, texts: list[bytes | None]) -> tuple[list[str | None], dict[int, str]]:
        """Texts with their safe cuts marked, and apart from them those to be encoded as a whole.

        A space is safe after a byte that ends no white space; a stop or comma after a letter or
        digit; a line end in front of a byte that starts no white space. Where that is not known
        from the bytes nearby, the cut counts as unsafe.
        """
        lengths = np.array([len(t) + 1 if t else 1 for t in texts], np.int64)
        joined = b"\0" * 2 + b"\0".join([t or b"" for t in texts]) + b"\0"
        data = np.frombuffer(joined, np.uint8)
        classes = np.frombuffer(joined.translate(_CLASS), np.uint8)
        blank, plain = classes == 1, classes == 2
        now, last, before = data[2:], data[1:-1], data[:-2]
        two = (last >= 128) & (before >= 0xC3) & (before <= 0xDF)  # ends a letter or mark of two bytes
        space = (now == 32) & (blank[1:-1] | (last >= 128) & ~two | (last == 0))
        letter = plain[1:-1] | (two & (before == 0xC3) & (last != 0x97) & (last != 0xB7))
        coarse = ((now == 44) | (now == 46)) & ~letter
        coarse |= (last == 10) & (blank[2:] | (now >= 128) & (now != 0xC3))
        whole_ones = space | (now == 1) | (now == 0) & (last == 32)
        ends = np.cumsum(lengths)
        uncut, rough = (np.bincount(np.searchsorted(ends, np.flatnonzero(x), "right"), minlength=len(texts)) for x in (whole_ones, coarse))
        marked: list[str | None] = []
        whole: dict[int, str] = {}
        for at, raw in enumerate(texts):
            text = raw.decode() if raw else None
            if text and (uncut[at] or "\0" in text or any(s in text for s in self.special)):
                whole[at], text = text, None
            if text:
                text = text.replace(" ", _CUT + " ")
                if not rough[at]:
                    text = text.replace(".", _CUT + ".").replace(",", _CUT + ",").replace("\n", _CUT + "\n" + _CUT)
            marked.append(text)
        return marked, whole

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of every text as uint32 arrays; a null text has none."""
        if len(self.codes) > REMEMBERED:
            self._thin()
        marked, whole = self._marked(texts)
        lists = pc.split_pattern(pa.array(marked, pa.large_string()), _CUT)
        stops = lists.offsets.to_numpy()
        coded = lists.values.slice(stops[0], stops[-1] - stops[0]).dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        codes = np.fromiter(map(self.codes.get, chunks, repeat(-1)), np.int64, len(chunks))
        if len(missing := np.flatnonzero(codes < 0)):
            new = [chunks[i] for i in missing.tolist()]
            self._learn(new)
            codes[missing] = np.fromiter(map(self.codes.__getitem__, new), np.int64, len(new))
        self.met[codes] += 1  # every code once
        first, size = self.first[codes], self.length[codes]
        order = coded.indices.to_numpy()
        sizes = size[order]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        spots = np.repeat(first[order] - (ends - sizes), sizes)
        spots += np.arange(total)
        ids = self.flat.take(spots)
        cuts = np.concatenate([[0], ends])[stops - stops[0]]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for at, text in whole.items():
            out[at] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return out


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker for ``path``; kept between tasks."""
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]
