"""Encoding of whole texts with a public tokenizer file, with few and large library calls.

Both vocabularies split text before their merges in such a way that a space after
a visible character always starts a new unit, that a run of sentence marks behind
letters is a unit of its own, and that a single line end between visible characters
is one too. So a text is cut at those places, the library encodes each distinct run of
letters once, many in one call, and the ids of a text are those of its units in
order. Units of any other kind are encoded by the library as they are, and texts in
which white space stands before a space, where the cut would not be exact, whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marketloom.llm import common

#: White space before a space: the split before the merges looks across it.
_RUN = re.compile(r"\s ")
#: White space other than spaces and line ends.
_ODD = re.compile(r"[^\S \n]")
_TAIL = ".,;:!?"


def _is_word(core: str) -> bool:
    """Whether a unit's core is letters and still ends in one when normalised and lower-cased.

    Some letters end in a mark then (capital I with dot, letters that NFC takes apart), and a mark forms one unit with the signs behind it.
    """
    return core.isalpha() and (core[-1] < "\u0100" or normalize("NFC", core[-1]).lower()[-1].isalpha())


def id_type(path: str) -> np.dtype:
    """The narrowest unsigned type for the ids of a tokenizer file."""
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


class UnitEncoder:
    """Encodes texts to little-endian unsigned ids; ``dtype`` is the id type.

    keeps_space: the vocabulary has white space in its units (byte-level BPE);
    otherwise white space only separates units, and case does not count.
    limit: units kept from batch to batch; more are encoded anew in each batch.
    """

    def __init__(self, path: str, keeps_space: bool, limit: int = 1_200_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space, self.limit = keeps_space, limit
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        #: Ids that begin a unit with a space, or end a unit.
        self.edge = np.zeros(size, bool)
        for token, i in vocabulary.items():
            self.edge[i] = token.startswith("Ġ") if keeps_space else token.endswith("</w>")
        self.words: dict[str, bytes] = {"": self._alone(" " if keeps_space else "")}
        self.heads: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.line_end = self._alone("\n")

    def _alone(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _mark(self, tail: str) -> bytes:
        found = self.marks.get(tail)
        if found is None:
            found = self._alone(tail)
            if len(self.marks) < 10_000:
                self.marks[tail] = found
        return found

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters, each with a space before it where spaces are kept."""
        out: dict[str, bytes] = {}
        lead = " " if self.keeps_space else ""
        groups = [words[i : i + 400] for i in range(0, len(words), 400)]
        for at in range(0, len(groups), 25):
            part = groups[at : at + 25]
            coded = self.tokenizer.encode_batch_fast([lead + " ".join(g) for g in part], add_special_tokens=False)
            for group, one in zip(part, coded):
                ids = np.array(one.ids, self.dtype)
                cuts = np.flatnonzero(self.edge[ids])
                if len(cuts) != len(group):
                    out.update((w, self._alone(lead + w)) for w in group)
                    continue
                cuts = np.append(cuts, len(ids)) if self.keeps_space else np.concatenate([[0], cuts + 1])
                raw, cuts = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
                out.update(zip(group, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
        return out

    def _units(self, units: set[str]) -> dict[str, bytes]:
        """Ids of units that are not kept."""
        plain: list[str] = []
        tailed: list[tuple[str, str]] = []
        odd: list[str] = []
        for unit in units:
            if unit.isalpha():
                plain.append(unit)
                continue
            core = unit.rstrip(_TAIL)
            if _is_word(core):
                tailed.append((unit, core))
            else:
                odd.append(unit)
        kept, room = self.words, len(self.words) < self.limit
        new = self._letters(list({*plain, *(c for _, c in tailed if c not in kept)}))
        out = {u: new[u] for u in plain}
        for unit, core in tailed:
            out[unit] = (new[core] if core in new else kept[core]) + self._mark(unit[len(core) :])
        if room:
            kept.update(new)
            # Words with a mark behind them are quick to put together: part of the room is theirs.
            if len(kept) < self.limit * 2 // 3:
                kept.update(out)
        lead = " " if self.keeps_space else ""
        for at in range(0, len(odd), 20_000):
            part = odd[at : at + 20_000]
            got = self.tokenizer.encode([lead + w for w in part], is_pretokenized=True, add_special_tokens=False)
            ids, words = np.array(got.ids, self.dtype), np.array(got.word_ids, np.int64)
            cuts = (np.searchsorted(words, np.arange(len(part) + 1)) * self.dtype.itemsize).tolist()
            raw = ids.tobytes()
            out.update((w, raw[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))
        return out

    def _cut(self, text: str) -> list[str]:
        """The units of a text without the spaces before them."""
        if self.keeps_space:
            return text.split(" ")
        if "<|" not in text and (text.isascii() or is_normalized("NFC", text) and "Σ" not in text and "İ" not in text):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        lines: list[int] = []
        whole: set[int] = set()
        if self.keeps_space:
            # A line end between visible characters is a unit, and what follows it has no
            # space: lines are encoded apart, their first words without a space.
            pieces: list[str] = []
            for text in texts:
                if _ODD.search(text):
                    own = [text]
                    if _RUN.search(text):
                        whole.add(len(pieces))
                elif "  " in text or "\n " in text:
                    whole.add(len(pieces))
                    own = [text]
                elif " \n" in text or "\n\n" in text or text[:1] == "\n" or text[-1:] == "\n":
                    own = [text]
                else:
                    own = text.split("\n")
                pieces += own
                lines.append(len(own))
        else:
            pieces = texts
        parts = [None if i in whole else self._cut(p) for i, p in enumerate(pieces)] if whole else list(map(self._cut, pieces))
        seen: set[str] = set()
        first: set[str] = set()
        for part in parts:
            if part is not None:
                rest = iter(part)
                if self.keeps_space:
                    first.add(next(rest))
                seen.update(rest)
        # The units of these texts in a table of their own, small beside what is kept.
        new = seen.difference(self.words)
        known = seen.difference(new)
        units = dict(zip(known, map(self.words.__getitem__, known)))
        units.update(self._units(new) if new else {})
        get, heads = units.__getitem__, self._heads(first) if first else {}
        out = []
        for piece, part in zip(pieces, parts):
            if part is None:
                out.append(self._alone(piece))
            elif self.keeps_space:
                rest = iter(part)
                out.append(heads[next(rest)] + b"".join(map(get, rest)))
            else:
                out.append(b"".join(map(get, part)))
        if not self.keeps_space:
            return out
        joined, at = [], 0
        for n in lines:
            joined.append(self.line_end.join(out[at : at + n]))
            at += n
        return joined

    def _heads(self, units: set[str]) -> dict[str, bytes]:
        """Ids of units without a space before them, many in one call with line ends between."""
        out = {u: self.heads[u] for u in units if u in self.heads}
        cores: set[str] = set()
        plan: list[tuple[str, str, str]] = []
        for unit in [u for u in units if u not in out]:
            core = unit.rstrip(_TAIL)
            if _is_word(core):
                plan.append((unit, core, unit[len(core) :]))
                cores.add(core)
            else:
                out[unit] = self._alone(unit)
        end, new = np.frombuffer(self.line_end, self.dtype), {}
        words = [c for c in cores if c not in self.heads]
        groups = [words[i : i + 400] for i in range(0, len(words), 400)]
        for group, one in zip(groups, self.tokenizer.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(one.ids, self.dtype)
            cuts = np.flatnonzero(ids == end[0]) if len(end) == 1 else []
            if len(cuts) != len(group) - 1:
                new.update((w, self._alone(w)) for w in group)
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            stops = [*(cuts * width).tolist(), len(raw)]
            new.update((w, raw[x:y]) for w, x, y in zip(group, [0, *((cuts + 1) * width).tolist()], stops))
        if len(self.heads) < self.limit // 5:
            self.heads.update(new)
        out.update((u, (new[c] if c in new else self.heads[c]) + self._mark(t)) for u, c, t in plan)
        return out


def encoder(path: str, keeps_space: bool) -> UnitEncoder:
    """An encoder that the tasks of one Python worker share, with the units it has kept."""
    return common.worker_store(("encoder", path, keeps_space), lambda: UnitEncoder(path, keeps_space))


def slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of a text column each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start, n = 0, batch.num_rows
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most)))
        yield batch.slice(start, stop - start)
        start = stop
