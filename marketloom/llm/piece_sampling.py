"""SentencePiece decoding and sampled encoding: Gumbel top-k without replacement.

A text is normalised by the model and cut before each word mark; no piece crosses such
a cut. Every way to write the words in pieces of the vocabulary is a path in a
lattice. A piece's log weight is ``alpha`` times the model's score of it; characters
outside the vocabulary are their bytes. A segmentation's probability is its product of
weights over the sum for all segmentations of the text.

The ``k`` segmentations with the largest Gumbel-perturbed log probabilities are
found from the best one on. A perturbed A-star search keeps a queue of subtrees, each with its own perturbed maximum as bound; here
the whole frontier has one maximum instead, and the subtree that holds it is drawn given that, which has the same law and needs no queue: backward sums over the lattice give the
mass of every subtree, so the largest perturbed value in a set of subtrees can be drawn
at once, truncated at the last value found, and the subtree that holds it is drawn by
mass. The first path is drawn from the root. Beside each of its words stand the
subtrees in which this word is cut otherwise; they are the frontier. The next
segmentation leaves the known paths at a frontier word, takes there a cut that is not
known yet, and brings the words behind it to the frontier. So k distinct segmentations
cost k paths, and none is drawn twice.

All draws are hashes of (seed, row key, sample, place), so a row's samples depend on
nothing but the row, whatever task or batch it is in. Words of all texts of a batch
are drawn in lock step with numpy; a draw that leads to a word's likeliest path takes
that path's stored sums, which are those that the steps would give; ids and decoded bytes are built for a whole batch,
and the decoded bytes are compared with the text. For a sample of log probability p and the
(k+1)-th largest value t, its inclusion score is log(1 - exp(-exp(p - t))), the log
of the probability to be included given the threshold.

Defined results: null and empty texts have one segmentation, the empty one, with log
probability 0; a text with fewer than k segmentations has fewer samples, and as all
of them are included, inclusion score 0; segmentations under 1e-300 of the mass of a
word count as impossible; rows without an id are drawn as those with id 0; repeated rows
get equal samples; very long texts are sampled whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common, tokens

_WORD = re.compile("▁*[^▁]+|▁+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Spreads hashes of short strings over the upper bits.
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BYTE = re.compile("<0x([0-9A-F]{2})>")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(keys: np.ndarray, *salts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1), each a hash of a key and salts."""
    for salt in salts:
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + np.asarray(salt).astype(np.uint64))
    return ((keys >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def truncated_gumbel(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The largest perturbed value of a subtree of log mass ``location``, at most ``bound``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return location - np.log(np.exp(np.minimum(location - bound, 700)) - np.log(u))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all ranges, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Pieces of a model with their weights, and decoding."""

    def __init__(self, path: str, alpha: float = 0.001) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.log_weight = alpha * np.array([self.model.get_score(i) for i in range(n)])
        known: dict[str, int] = {}
        self.bytes = np.zeros(256, np.int64)
        for i, piece in enumerate(self.pieces):
            if self.model.is_byte(i):
                self.bytes[int(_BYTE.fullmatch(piece)[1], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                known[piece] = i
        self.raw = [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.encode() for i, x in enumerate(self.pieces)]
        #: Bytes of all pieces, end to end.
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.size = np.array([len(x) for x in self.raw], np.int64)
        self.place = np.cumsum(self.size) - self.size
        self.longest = max(map(len, known))
        found: dict[int, int] = {}
        for piece, i in known.items():
            h = 0
            for c in piece:
                h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
                found.setdefault(h * int(_SPREAD) % (1 << 64), -1)
            found[h * int(_SPREAD) % (1 << 64)] = i
        ordered = sorted(found)
        #: Hashes of pieces and of their beginnings, sorted, with the ids of pieces, else -1; the last is beyond all.
        self.keys = np.array([*ordered, (1 << 64) - 1], np.uint64)
        self.ids = np.array([*(found[k] for k in ordered), -1], np.int64)
        #: The first key with these upper 20 bits or higher ones.
        self.slots = np.searchsorted(self.keys[:-1] >> np.uint64(44), np.arange(1 << 20, dtype=np.uint64)).astype(np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are among the keys, and the ids of those."""
        h = h * _SPREAD
        place = self.slots[(h >> np.uint64(44)).view(np.int64)]
        key = self.keys[place]
        late = np.flatnonzero(key < h)
        while len(late):
            place[late] += 1
            key[late] = self.keys[place[late]]
            late = late[key[late] < h[late]]
        hit = np.flatnonzero(key == h)
        return hit, self.ids[place[hit]]

    def normalise(self, text: str | None) -> str:
        return self.model.Normalize(text) if text else ""

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, end to end."""
        return self.flat[ragged(self.place[ids], self.size[ids])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, with bytes joined to characters."""
        text = self.decoded(np.array(ids, np.int64)).tobytes().decode("utf-8", "replace").replace("▁", " ")
        return text[1:] if text[:1] == " " else text


class Lattices:
    """Lattices of words, flat: nodes have ranges of edges, edges lead to nodes.

    The edges of a node stand with the likeliest first. ``run`` is the probability of
    those before an edge, ``others`` that of all others of its node. A word's ``best``
    path takes the first edge of each of its nodes; draws below ``best_below`` lead to it.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 300_000) -> None:
        self.vocabulary, self.limit = vocabulary, limit
        self.room: dict[str, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        #: Numbers of words.
        self.number: dict[str, int] = {}
        self.n_nodes = 0
        self.start, self.best_at, self.best_size = (np.zeros(0, np.int64) for _ in range(3))
        self.best_log_p, self.best_rest, self.best_below = (np.zeros(0) for _ in range(3))
        self.best_edges = np.zeros(0, np.int64)
        self.run, self.p, self.log_p, self.others = (np.zeros(0) for _ in range(4))
        self.target, self.tokens = np.zeros(0, np.int32), np.zeros(0, np.int32)
        #: Ids of characters outside the vocabulary, end to end; token -1 - i stands for range i. ``odd``: tokens of such characters.
        self.odd: dict[int, int] = {}
        self.raw, self.raw_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first_edge = np.zeros(1, np.int64)

    def add(self, words: list[str]) -> None:
        """Build the lattices of new words side by side.

        Pieces are found by hashes of substrings that begin a piece, one length at a time;
        masses of suffixes are summed from the words' ends on, all words in lock step, in logs.
        Nodes are numbered by their distance to the word's end. The sums of a node hold
        nothing of other nodes, so they do not depend on the words beside.
        """
        v = self.vocabulary
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(codes)
        room = np.repeat(ends, sizes) - np.arange(n)
        by_distance = np.argsort(room.astype(np.uint16) if sizes.max() < 1 << 16 else room, kind="stable")
        node = np.empty(n, np.int64)
        node[by_distance] = np.arange(n)
        #: Places in the text, ids and logs of the pieces of each length.
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at, h = np.arange(n), np.zeros(n, np.uint64)
        for length in range(1, v.longest + 1):
            h = h * _BASE + codes[at + (length - 1)]
            hit, ids = v.find(h)
            at, h = at[hit], h[hit]
            piece = np.flatnonzero(ids >= 0)
            ids = ids[piece]
            found.append((at[piece], ids, v.log_weight[ids]))
            on = np.flatnonzero(room[at] > length)
            at, h = at[on], h[on]
        alone = np.zeros(n, bool)
        alone[found[0][0]] = True
        lost = np.flatnonzero(~alone)
        if len(lost):
            own, back = np.unique(codes[lost], return_inverse=True)
            raw = [v.bytes[list(chr(c - 1).encode("utf-8", "replace"))] for c in own.tolist()]
            for c, r in zip(own.tolist(), raw):
                # One byte is a piece like any other; several stand in a range of their own.
                if c not in self.odd and len(r) > 1:
                    self.odd[c] = -1 - len(self.raw_size)
                    self.raw, self.raw_size = np.append(self.raw, r), np.append(self.raw_size, len(r))
            ids = np.array([self.odd[c] if len(r) > 1 else r[0] for c, r in zip(own.tolist(), raw)], np.int64)
            log = np.array([v.log_weight[r].sum() for r in raw])
            found[0] = tuple(map(np.concatenate, zip(found[0], (lost, ids[back], log[back]))))
        counts = np.bincount(node[np.concatenate([x for x, _, _ in found])], minlength=n)
        end = np.cumsum(counts)
        begin, size = end - counts, int(end[-1])
        # The longest piece of a node first: most nodes then have the likeliest first.
        width, token, target, logs = np.empty(size, np.int64), np.empty(size, np.int32), np.empty(size, np.int64), np.empty(size)
        free = end.copy()
        for length, (at, ids, log) in enumerate(found, 1):
            own = node[at]
            slot = free[own] - 1
            free[own] = slot
            width[slot], token[slot], logs[slot] = length, ids, log
            target[slot] = np.where(room[at] == length, -1, node[np.minimum(at + length, n - 1)])
        mass = np.zeros(n + 1)  # the last stands for the end of a word
        total = np.empty(size)
        stops = np.cumsum(np.bincount(room))
        for a, b in zip(stops[:-1].tolist(), stops[1:].tolist()):
            x, y = begin[a], end[b - 1]
            value = logs[x:y] + mass[target[x:y]]
            most = np.maximum.reduceat(value, begin[a:b] - x)
            mass[a:b] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, counts[a:b])), begin[a:b] - x))
            total[x:y] = value
        own = np.repeat(np.arange(n), counts)
        log_p = total - mass[own]
        # Without the lower bits, which rounding moves; then shorter ones first.
        rank = np.maximum(-log_p, 0.0).view(np.int64) >> 25
        wrong = (own[1:] == own[:-1]) & ((rank[1:] < rank[:-1]) | (rank[1:] == rank[:-1]) & (width[1:] < width[:-1]))
        nodes = own[1:][wrong]
        if len(nodes):
            nodes = nodes[np.concatenate([[True], nodes[1:] != nodes[:-1]])]
            old = ragged(begin[nodes], counts[nodes])
            if len(nodes) < 1 << 20 and v.longest < 32:
                # The upper bits of a float that is not negative sort as the float does, and take 38 bits here.
                order = old[np.argsort(np.repeat(np.arange(len(nodes)), counts[nodes]) << 43 | rank[old] << 5 | width[old])]
            else:
                order = old[np.lexsort((width[old], rank[old], own[old]))]
            token[old], target[old], log_p[old] = token[order], target[order], log_p[order]
        p = np.exp(log_p)
        run = np.zeros(size)
        at = begin[counts > 1] + 1
        while len(at):
            run[at] = run[at - 1] + p[at - 1]
            at = at[at + 1 < end[own[at]]] + 1
        # All but the likeliest edge have at most a half, so nothing is lost in 1 - p.
        rest = p.copy()
        rest[begin] = 0
        others = 1 - p
        others[begin] = np.add.reduceat(rest, begin)
        target[target >= 0] += self.n_nodes
        first = self.n_nodes + node[ends - sizes]
        for name, new in (("run", run), ("p", p), ("log_p", log_p), ("others", others), ("target", target), ("tokens", token)):
            self._append(name, new)
        self._append("first_edge", self.first_edge[-1] + end)
        self.n_nodes += n
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        at, size, log_p, rest, edges = self.walk(first, np.zeros(len(words)), None)
        # Four edges use one draw. Where rounding could matter, the walk decides.
        below = np.where(size <= 4, np.exp(log_p) * (1 - 1e-9), 0.0)
        at += len(self.best_edges)
        for name, new in (("at", at), ("size", size), ("log_p", log_p), ("rest", rest), ("below", below), ("edges", edges)):
            self._append(f"best_{name}", new)
        self._append("start", first)

    def _append(self, name: str, new: np.ndarray) -> None:
        """Put entries behind an array, whose room grows by doubling."""
        old, room = getattr(self, name), self.room.get(name)
        size = len(old) + len(new)
        if room is None or len(room) < size:
            self.room[name] = room = np.empty(2 * size, old.dtype)
            room[: len(old)] = old
        room[len(old) : size] = new
        setattr(self, name, room[:size])

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words; new words are added."""
        got = list(map(self.number.get, words))
        new = [w for w, i in zip(words, got) if i is None]
        if new:
            if len(self.number) + len(new) > self.limit and self.number:
                self.clear()
                got, new = [None] * len(words), words
            numbers = iter(range(len(self.number), len(self.number) + len(new)))
            self.add(new)
            got = [next(numbers) if i is None else i for i in got]
        return np.array(got, np.int64)

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node that u draws: from its first edge on while the next begins at most at u."""
        edge, last = self.first_edge[nodes], self.first_edge[nodes + 1] - 1
        live = np.flatnonzero(edge < last)
        level, at, last = u[live], edge[live], last[live]
        while len(live):
            go = self.run[at + 1] <= level
            live, level, at, last = live[go], level[go], at[go] + 1, last[go]
            edge[live] = at
            on = at < last
            if not on.all():
                live, level, at, last = live[on], level[on], at[on], last[on]
        return edge

    def walk(self, nodes: np.ndarray, u: np.ndarray, again: Callable[[np.ndarray, int], np.ndarray] | None) -> tuple[np.ndarray, ...]:
        """Draw from each node to the end of its word: where its edges are, how many, log probability, mass beside them, all edges.

        After each four edges, what is left of u has few bits; ``again`` draws it anew.
        """
        n = len(nodes)
        size, log_p, rest = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        live, before, steps = np.arange(n), np.ones(n), []
        while len(live):
            if again and steps and len(steps) % 4 == 0:
                u = again(live, len(steps))
            edge = self.draw(nodes, u)
            p = self.p[edge]
            steps.append((live, edge))
            size[live] += 1
            log_p[live] += self.log_p[edge]
            rest[live] += before * self.others[edge]
            then = self.target[edge]
            on = np.flatnonzero(then >= 0)
            u = np.clip((u[on] - self.run[edge[on]]) / p[on], 0.0, 1 - 1e-16)
            live, nodes, before = live[on], then[on].astype(np.int64), before[on] * p[on]
        begin = np.cumsum(size) - size
        edges = np.empty(int(size.sum()), np.int64)
        for depth, (who, edge) in enumerate(steps):
            edges[begin[who] + depth] = edge
        return begin, size, log_p, rest, edges

    def beside(self, start: int, known: list[tuple[int, ...]]) -> tuple[list[tuple[int, ...]], np.ndarray]:
        """The subtrees of a word that no known path enters, as the edges down to them, and their masses."""
        heads: list[tuple[int, ...]] = []
        masses: list[float] = []
        groups = [((), 1.0, start, known)]
        while groups:
            head, before, node, paths = groups.pop()
            depth = len(head)
            taken = {path[depth] for path in paths}
            first, end = self.first_edge[node : node + 2].tolist()
            for edge, p in enumerate(self.p[first:end].tolist(), first):
                mass = before * p
                if edge not in taken:
                    if mass > 1e-300:
                        heads.append((*head, edge))
                        masses.append(mass)
                elif self.target[edge] >= 0:
                    groups.append(((*head, edge), mass, int(self.target[edge]), [x for x in paths if x[depth] == edge]))
        return heads, np.array(masses)

    def ids(self, edges: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ranges of edges of the given sizes, and the sizes in ids."""
        tokens_ = self.tokens[edges].astype(np.int64)
        if not len(tokens_) or tokens_.min() >= 0:
            return tokens_, sizes
        several = tokens_ < 0
        which = -1 - tokens_[several]
        each = np.ones(len(tokens_), np.int64)
        each[several] = self.raw_size[which]
        out = np.repeat(tokens_, each)
        out[out < 0] = self.raw[ragged((np.cumsum(self.raw_size) - self.raw_size)[which], self.raw_size[which])]
        done = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(sizes)
        return out, done[ends] - done[ends - sizes]


def lattices_of(model: str, alpha: float) -> Lattices:
    """Lattices that the tasks of one Python worker share."""
    return common.worker_store(("lattices", model, alpha), lambda: Lattices(Vocabulary(model, alpha)))


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of texts, the place there of each word of the texts, end to end, and the texts' sizes in words."""
    if all(t[0] == "▁" != t[-1] and "▁▁" not in t for t in texts):
        lists = pc.split_pattern(pa.array([t[1:] for t in texts], pa.large_string()), "▁")
        sizes, flat, lead = pc.list_value_length(lists).to_numpy(), lists.flatten(), "▁"
    else:
        found = [_WORD.findall(t) for t in texts]
        sizes, flat, lead = np.fromiter(map(len, found), np.int64, len(found)), pa.array([w for x in found for w in x], pa.large_string()), ""
    coded = flat.dictionary_encode()
    return [lead + w for w in coded.dictionary.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(), sizes.astype(np.int64)


class Batch:
    """Texts of one batch, none of them empty: their words' start nodes, laid end to end, and the edges drawn."""

    def __init__(self, lattices: Lattices, texts: list[str], keys: list[int]) -> None:
        self.lattices, self.n = lattices, len(texts)
        words, self.code, sizes = words_of(texts)
        number = lattices.numbers(words)
        #: Of each distinct word.
        self.best_size, self.best_log_p = lattices.best_size[number], lattices.best_log_p[number]
        self.best_rest, self.best_below = lattices.best_rest[number], lattices.best_below[number]
        self.best_at = np.cumsum(self.best_size) - self.best_size
        #: Edges of all words of all paths; those of the best paths first.
        best = lattices.best_edges[ragged(lattices.best_at[number], self.best_size)]
        self.edges, self.n_edges = [best], len(best)
        self.start = lattices.start[number][self.code]
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        self.key = _mix(np.array(keys, np.int64).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        place = (np.arange(len(self.start)) - self.begin[self.doc]).astype(np.uint64)
        self.word_key = _mix(self.key[self.doc] * np.uint64(0x9E3779B97F4A7C15) + place)

    def keep(self, edges: np.ndarray) -> int:
        """Store edges; returns the place of the first."""
        self.edges.append(edges)
        self.n_edges += len(edges)
        return self.n_edges - len(edges)

    def walk(self, words: np.ndarray, nodes: np.ndarray, sample: int, u: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Draw from each node to the end of its word: where the edges are, how many, log probability, mass beside them."""
        key = self.word_key[words]
        u = uniforms(key, sample) if u is None else u
        at, size, log_p, rest, edges = self.lattices.walk(nodes, u, lambda live, depth: uniforms(key[live], sample, depth))
        return at + self.keep(edges), size, log_p, rest

    def walk_whole(self, words: np.ndarray, sample: int) -> tuple[np.ndarray, ...]:
        """``walk`` from the beginnings of words, without steps where the draw leads to the best path."""
        u, code = uniforms(self.word_key[words], sample), self.code[words]
        out = self.best_at[code], self.best_size[code], self.best_log_p[code], self.best_rest[code]
        other = np.flatnonzero(u >= self.best_below[code])
        for x, new in zip(out, self.walk(words[other], self.start[words[other]], sample, u[other])):
            x[other] = new
        return out


class Path:
    """One segmentation per text: per word where its edges are, how many, its log probability, and the frontier mass beside it."""

    def __init__(self, batch: Batch, at: np.ndarray, size: np.ndarray, log_p: np.ndarray, rest: np.ndarray, value: np.ndarray) -> None:
        self.at, self.size, self.word_log_p, self.value = at, size, log_p, value
        run = np.cumsum(log_p)
        self.before = run - log_p
        self.before -= self.before[batch.begin][batch.doc]
        self.log_p = np.add.reduceat(log_p, batch.begin)
        self.mass = np.exp(self.before) * rest


def top_k(batch: Batch, k: int) -> tuple[list[Path], np.ndarray]:
    """Paths of the k largest perturbed values, best first, and the next value per text.

    A path has value -inf for texts that have no segmentation left.
    """
    lat, n = batch.lattices, batch.n
    value = -np.log(-np.log(uniforms(batch.key, 3)))
    every = np.arange(len(batch.start))
    paths = [Path(batch, *batch.walk_whole(every, 1), value)]
    #: Cuts of a word that are known, by path and word.
    known: dict[tuple[int, int], list[tuple[int, ...]]] = {}
    for sample in range(2, k + 2):
        by_path = np.stack([np.add.reduceat(path.mass, batch.begin) for path in paths])
        total = by_path.sum(axis=0)
        some = total > 1e-300
        with np.errstate(divide="ignore"):
            value = np.where(some, truncated_gumbel(np.log(total), value, uniforms(batch.key, 5, sample)), -np.inf)
        if sample > k or not some.any():
            return paths, value
        docs = np.flatnonzero(some)
        pool = np.concatenate(batch.edges)
        draws, inside = uniforms(batch.key, 4, sample) * total, uniforms(batch.key, 6, sample)
        parent, leave = np.zeros(n, np.int64), batch.end.copy()
        for q in range(len(paths) - 1):
            go = np.flatnonzero((parent == q) & ((draws >= by_path[q]) | (by_path[q] == 0)) & by_path[q + 1 :].any(axis=0))
            draws[go] -= by_path[q, go]
            parent[go] = q + 1
        #: Per text the word, the subtree, the mass of the subtrees beside it, and its own.
        chosen: list[tuple[int, int, tuple[int, ...], float, float]] = []
        for d, q, left, begin, end in zip(*(x[docs].tolist() for x in (np.arange(n), parent, draws, batch.begin, batch.end))):
            mass = paths[q].mass[begin:end]
            run = mass.cumsum()
            place = int(run.searchsorted(min(max(left, 0.0), float(run[-1])), side="right"))
            if place == len(run):  # never a word without mass, whatever the rounding
                place = int(np.flatnonzero(mass)[-1])
            w = begin + place
            path = paths[q]
            cuts = known.setdefault((q, w), [tuple(pool[path.at[w] : path.at[w] + path.size[w]].tolist())])
            heads, masses = lat.beside(int(batch.start[w]), cuts)
            run = masses.cumsum()
            which = min(int(run.searchsorted(inside[d] * run[-1], side="right")), len(heads) - 1)
            mass = float(masses[which])
            masses[which] = 0.0
            chosen.append((d, w, heads[which], float(masses.sum()), mass))
            leave[d] = w
        # The rest of the word, and all words behind it, are drawn anew.
        words = np.array([w for _, w, *_ in chosen], np.int64)
        then = lat.target[[head[-1] for _, _, head, *_ in chosen]].astype(np.int64)
        on = np.flatnonzero(then >= 0)
        at, size, _, rest = batch.walk(words[on], then[on], sample)
        tails = dict(zip(on.tolist(), zip(at.tolist(), size.tolist(), rest.tolist())))
        pool = np.concatenate(batch.edges)
        own = np.empty(len(words)), np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        cut_edges: list[int] = []
        for i, (d, w, head, left, mass) in enumerate(chosen):
            a, m, beside = tails.get(i, (0, 0, 0.0))
            cut = (*head, *pool[a : a + m].tolist())
            cuts = known[parent[d], w]
            cuts.append(cut)
            left += mass * beside
            if left < 1e-290:  # then those that count as impossible matter
                left = lat.beside(int(batch.start[w]), cuts)[1].sum()
            path = paths[parent[d]]
            path.mass[w] = np.exp(path.before[w]) * left
            own[0][i], own[1][i], own[2][i] = lat.log_p[list(cut)].sum(), len(cut_edges), len(cut)
            cut_edges += cut
        base = batch.keep(np.array(cut_edges, np.int64))
        source = parent[batch.doc]
        new = [getattr(paths[0], name).copy() for name in ("at", "size", "word_log_p")]
        for q, path in enumerate(paths[1:], 1):
            other = np.flatnonzero(source == q)
            for x, name in zip(new, ("at", "size", "word_log_p")):
                x[other] = getattr(path, name)[other]
        new[0][words], new[1][words], new[2][words] = own[1] + base, own[2], own[0]
        later = np.flatnonzero(every > leave[batch.doc])
        rest = np.zeros(len(every))
        new[0][later], new[1][later], new[2][later], rest[later] = batch.walk_whole(later, sample)
        paths.append(Path(batch, *new, rest, value))
    return paths, value


SAMPLES = (
    "doc_id long, sample int, n_pieces long, log_p double, perturbed double, log_inclusion double, "
    "ids_crc32 long, round_trip boolean"
)


def log_inclusion(log_p: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Log of the probability that a perturbed value exceeds the threshold."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        excess = np.exp(np.minimum(log_p - threshold, 700))
        return np.where(np.isneginf(threshold), 0.0, np.where(excess > 1e-12, np.log(-np.expm1(-excess)), log_p - threshold))


def sampled(lattices: Lattices, texts: list[str], keys: list[int], k: int, with_ids: bool) -> list[tuple]:
    """Rows (text's number, sample, n_pieces, log_p, perturbed, log_inclusion, crc, round_trip[, ids]) of normalised texts."""
    full = [i for i, t in enumerate(texts) if t]
    rows: list[tuple] = []
    for i, text in enumerate(texts):
        if not text:
            value = float(-np.log(-np.log(uniforms(_mix(np.array([keys[i]], np.int64).view(np.uint64)), 3)))[0])
            rows.append((i, 1, 0, 0.0, value, 0.0, zlib.crc32(b""), True) + (([],) if with_ids else ()))
    if not full:
        return rows
    batch = Batch(lattices, [texts[i] for i in full], [keys[i] for i in full])
    paths, following = top_k(batch, k)
    pool = np.concatenate(batch.edges)
    plain = [texts[i].encode("utf-8", "replace") for i in full]
    want = np.frombuffer(b"".join(plain), np.uint8)
    for number, path in enumerate(paths, 1):
        ids, sizes = lattices.ids(pool[ragged(path.at, path.size)], np.add.reduceat(path.size, batch.begin))
        got = lattices.vocabulary.decoded(ids)
        ends = np.cumsum(sizes)
        same = [True] * len(full)
        if not np.array_equal(got, want):
            stops = np.cumsum(np.add.reduceat(lattices.vocabulary.size[ids], ends - sizes))
            same = [got[b - len(x) : b].tobytes() == x and b - a == len(x) for x, a, b in zip(plain, [0, *stops[:-1]], stops)]
        raw = memoryview(ids.astype("<u4").tobytes())
        inclusion = log_inclusion(path.log_p, following)
        for d, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist())):
            if path.value[d] > -np.inf:
                row = (full[d], number, b - a, float(path.log_p[d]), float(path.value[d]), float(inclusion[d]), zlib.crc32(raw[4 * a : 4 * b]), same[d])
                rows.append(row + ((ids[a:b],) if with_ids else ()))
    return rows


def sample_segmentations(
    docs: DataFrame, model: str, k: int = 3, alpha: float = 0.001, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per document and sample, see ``SAMPLES``; with the ids if asked for."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [(name, kinds[kind]) for name, kind in (c.split() for c in SAMPLES.split(", "))]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = lattices_of(model, alpha)
        for whole in batches:
            for part in tokens.slices(whole, "text", 600_000):
                ids, texts = (c.to_pylist() for c in part.columns)
                texts = [lattices.vocabulary.normalise(t) for t in texts]
                rows = sampled(lattices, texts, [(i or 0) ^ seed for i in ids], k, with_ids)
                columns = list(zip(*rows))
                columns[0] = [ids[i] for i in columns[0]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, SAMPLES + ", ids array<long>" * with_ids)


def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sample_segmentations(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
