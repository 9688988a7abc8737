"""Packing by lexical retrieval: every training window is filled with documents that share words with its first one.

1. Documents are tokenised once and staged with their ids. Each task adds the document frequencies of its tokens; they are summed
   over all documents. The vocabulary bounds that table, so its broadcast is bounded, too.
2. Documents are brought into an order in which related ones stand together: by the sides of ``DIRECTIONS`` principal directions they
   are on, then by three of their terms, chosen by weighted minimal hashes, so that copies agree in all three. Weights
   are the document frequencies of 1. The directions are those of a second scan over all documents: each is folded into ``SKETCH`` numbers
   (terms are added up with hashed signs), and tasks add up the products of these. The driver sees one matrix of that size.
3. In this order they are dealt out in shards with about ``SHARD_TOKENS`` ids each. A task
   builds a BM25 index of each shard (with the corpus-wide frequencies and mean length) and packs it: the next unused
   document is the seed of a window; the index returns its best unused neighbours by all of its tokens, which fill the
   window one after the other, as long as there are any; then the next unused document is the seed. The one that does
   not fit is cut, and its rest is the seed of the next window. So all windows are full.
   What remains at a shard's end is cut into sequences whose lengths are powers of two, which need no padding.

One shuffle moves the ids, by ranges of (order, number of the row), so that no group of copies is too large for a range. A task
holds one shard at a time, whatever the size of its partition.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import islice
from unicodedata import category, is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import BLANKS, SLICE_BYTES, Scratch, byte_views, col, kept_in_process, mix, numbered, slices

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 2_000_000
#: The usual constants of BM25.
K1, B = 1.2, 0.75
#: Directions that documents are ordered by, and the length of the sketches they are found in.
DIRECTIONS, SKETCH = 3, 128
#: Parts of a sketch's length: its numbers are rounded to these, so that sums do not depend on how rows are dealt to tasks.
STEPS = 4096
#: Odd words whose ids a worker remembers before it forgets some; for memory only, without effect on results.
REMEMBERED = 100_000
#: Longer words are left to the tokenizer itself.
LONG_WORD = 4096
#: Places for pieces whose ids a worker remembers (a power of two), and the bytes of such a piece at most (two numbers); for speed only.
SLOTS, SHORT = 1 << 18, 16


def byte_letters() -> dict[int, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return dict(zip([*plain, *(b for b in range(256) if b not in plain)], [*plain, *range(256, 512)]))


def ranked_merges(definition: str):
    """The tiktoken library with a definition's vocabulary, in which a line feed stands for the end of a piece; None if that is not exact.

    The library joins the two neighbours whose union has the least id, whichever merge made that id. This is the same as
    the merges in their order if ids ascend with the merges, single bytes come first, and every token's own bytes become that token
    alone: two neighbours that no merge joins never make up a token then, since that token by itself would have ended as these two.
    """
    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    model = json.loads(definition)["model"]
    suffix = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not suffix or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    letters = {chr(v): k for k, v in byte_letters().items()}
    single = {c + e for c in letters for e in ("", suffix)}
    if made != sorted(set(made)) or len(made) + len(single) != len(vocab) or any(vocab.get(t, len(vocab)) >= min(made, default=0) for t in single):
        return None
    inner, last = BPE(vocab, merges), Tokenizer.from_str(definition).model
    ranks = {}
    for token, i in vocab.items():
        stem = token.removesuffix(suffix)
        if not set(stem) <= letters.keys() or [t.id for t in (inner if stem == token else last).tokenize(stem)] != [i]:
            return None
        ranks[bytes(letters[c] for c in stem) + (b"" if stem == token else b"\n")] = i
    return tiktoken.Encoding("pieces", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})


def odd_pairs() -> np.ndarray:
    """By value of the first two bytes: is this a two-byte character, but not a letter up to U+04FF that lower case and composition leave as it is?"""
    odd = np.zeros(1 << 16, bool)
    odd[0xC200:0xE000] = True
    for c in map(chr, range(0x80, 0x500)):
        if category(c)[0] == "L" and c.lower() == c and is_normalized("NFC", c):
            odd[int.from_bytes(c.encode(), "big")] = False
    return odd


class Pieces:
    """The ids of pieces, most of them remembered: the library sees a short piece only when its place holds another one.

    A short piece is two whole numbers, its bytes (none is zero), so it is compared in full. Its hash is its place in a table; what
    stands there gives way to another piece unless it was asked for since the last one that wanted the place. All of this is
    done by arrays, for all pieces of some texts at once.
    """

    #: What is left of eight bytes by the number of those that belong to the piece.
    MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, merges, vocabulary: int, dtype):
        self.merges = merges
        self.closes = np.zeros(vocabulary, bool)
        self.closes[[i for token, i in merges._mergeable_ranks.items() if token[-1:] == b"\n" and token != b"\n"]] = True
        # An empty place is taken for no piece, since none has zeros.
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.sizes, self.asked = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, bool)
        #: A piece that wants each place.
        self.wanted = np.zeros(SLOTS, np.int32)
        #: As many ids for each place as a piece can have; behind them those that the library gave last.
        self.ids = np.zeros(SLOTS * SHORT, dtype)

    def encode(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of ``data`` from ``begins`` to ``ends``, at which a line feed stands, and how many each has."""
        eight = np.ndarray(len(data) + 8, "<u8", np.concatenate((data, np.zeros(SHORT, np.uint8))), strides=(1,))
        length = ends - begins
        low = eight[begins] & self.MASKS[np.minimum(length, 8)]
        high = eight[begins + np.minimum(length, 8)] & self.MASKS[np.clip(length - 8, 0, 8)]
        place = (mix(low ^ mix(high)) & np.uint64(SLOTS - 1)).astype(np.intp)
        known = (self.low[place] == low) & (self.high[place] == high) & (length <= SHORT)
        self.asked[place[known]] = True
        starts, sizes = place * SHORT, self.sizes[place]
        # Of equal pieces one goes to the library, unless another piece wants their place.
        short = np.flatnonzero(~known & (length <= SHORT))
        self.wanted[place[short]] = short
        first = self.wanted[place[short]]
        again = (first != short) & (low[first] == low[short]) & (high[first] == high[short])
        new = ~known
        new[short[again]] = False
        new = np.flatnonzero(new)
        if len(new):
            starts[new], sizes[new] = self._learn(data, begins[new], ends[new])
            starts[short[again]], sizes[short[again]] = starts[first[again]], sizes[first[again]]
        out = self.ids[spread(starts, sizes)]
        comes = short[first == short]
        kept = self.asked[place[comes]]
        self.asked[place[comes]] = False
        comes = comes[~kept]
        own = place[comes]
        self.low[own], self.high[own], self.sizes[own] = low[comes], high[comes], sizes[comes]
        self.ids[spread(own * SHORT, sizes[comes])] = self.ids[spread(starts[comes], sizes[comes])]
        return out, sizes

    def _learn(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids that the library gives for some pieces begin in ``self.ids``, and how many each has."""
        edge = np.zeros(len(data) + 1, np.int8)
        edge[begins] = 1
        edge[ends + 1] -= 1
        ids = self.merges.encode_to_numpy(data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)].tobytes().decode())
        last = SLOTS * SHORT
        if len(self.ids) < last + len(ids):
            self.ids = np.concatenate((self.ids[:last], np.zeros(len(ids), self.ids.dtype)))
        self.ids[last : last + len(ids)] = ids
        behind = np.flatnonzero(self.closes[ids]) + 1
        return last + np.concatenate(([0], behind[:-1])), np.diff(behind, prepend=0)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size says."""
    behind = np.cumsum(sizes)
    return np.repeat(starts - behind + sizes, sizes) + np.arange(behind[-1] if len(behind) else 0)


class Encoder:
    """Token ids of many texts at once, as the tokenizers library gives them for each alone.

    That is exact for byte-level tokenizers that drop white space, never join across it, take lower case, and part letters, single
    digits and runs of other characters. Whether the given one does is tried out first; if not, texts are tokenised whole.
    Words of ASCII and plain letters are cut into pieces by arrays and go through :func:`ranked_merges`, most only once. Words with
    anything else (apostrophes begin suffixes of their own) go through the tokenizer, each distinct one once.
    """

    PROBE = "it's a  Word, two.words (3rd) x--y \u00e9t\u00e9; \u00c9t\u00e9 l'\u00e9t\u00e9... \tend!? a1b2 12.5% \u00df\u4e2d\u6587, don't. ab, cd's; &&& e&&& unanswerable"
    LOWER = bytes(10 if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
    #: Bytes that make a word odd: apostrophes, control characters, and the first ones of characters of three bytes or more.
    ODD = np.array([b == 39 or b < 9 or 14 <= b < 32 or b == 127 or b >= 0xE0 for b in range(256)])
    ODD_PAIRS = odd_pairs()
    #: Line feeds 0, letters 1, digits 2, other characters 3.
    KIND = np.array([0 if b == 10 else 1 if b >= 128 or 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3 for b in range(256)], np.uint8)

    def __init__(self, definition: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for _, t in sorted(added.items()) if t.special and " " not in t.content]
        self.vocabulary = max([self.tokenizer.get_vocab_size() - 1, *added]) + 1
        self.dtype = np.uint16 if max(end + 1, self.vocabulary) <= 65536 else np.uint32
        self.end = np.array([end], self.dtype).tobytes()
        self.marks = [s.encode().lower() for s in self.special]
        self.known: dict[bytes, np.ndarray] = {}
        merges = ranked_merges(definition) if self.special else None
        self.by_word = merges is not None
        if self.by_word:
            self.pieces = Pieces(merges, self.vocabulary, self.dtype)
            probe = [memoryview(self.PROBE.encode())]
            self.by_word = self.encode(probe) == self._whole(probe)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, texts: list[memoryview]) -> list[bytes]:
        return [ids.tobytes() + self.end for ids in self._ids([bytes(t).decode("utf-8", "replace") for t in texts])]

    def _learn(self, words: set[bytes]) -> None:
        """Remembers the ids of odd words, some hundred in one string, parted by a special token; words that hold one themselves go alone."""
        if len(self.known) + len(words) > REMEMBERED:
            # What was learned first is mostly what is frequent.
            self.known = dict(islice(self.known.items(), REMEMBERED // 2))
        alone = [w for w in words if len(w) > LONG_WORD or any(m in w.lower() for m in self.marks)]
        self.known.update(zip(alone, self._ids([w.decode() for w in alone])))
        others = [*words.difference(alone)]
        part = self.tokenizer.token_to_id(self.special[0])
        groups = [others[i : i + 500] for i in range(0, len(others), 500)]
        for own, ids in zip(groups, self._ids([self.special[0].join(w.decode() for w in g) for g in groups])):
            cuts = np.flatnonzero(ids == part).tolist()
            for w, first, last in zip(own, [0, *[c + 1 for c in cuts]], [*cuts, len(ids)]):
                self.known[w] = ids[first:last]

    def _odd_words(self, lower: bytes, data: np.ndarray) -> list[tuple[int, int]]:
        """Where odd and very long words begin and end."""
        leads = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
        pairs = data[leads].astype(np.uint16) << 8 | data[leads + 1]
        at = [*np.flatnonzero(self.ODD[data]).tolist(), *leads[self.ODD_PAIRS[pairs]].tolist()]
        at += [m.start() for mark in self.marks if mark in lower for m in re.finditer(re.escape(mark), lower)]
        blanks = np.concatenate(([-1], np.flatnonzero(data == 10)))
        at += (blanks[:-1][np.diff(blanks) > LONG_WORD] + 1).tolist()
        if not at:
            return []
        after = np.unique(np.searchsorted(blanks, np.array(at)))
        return list(zip((blanks[after - 1] + 1).tolist(), blanks[after].tolist()))

    def _parts(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part; the parts together are of a bounded size."""
        whole = b"\n".join(parts) + b"\n"
        lower = whole.translate(self.LOWER)
        data = np.frombuffer(bytearray(lower), np.uint8)
        odd = self._odd_words(lower, data)
        words = [whole[a:b] for a, b in odd]
        new = {w for w in words if w not in self.known}
        if new:
            self._learn(new)
            self._learn({w for w in words if w not in self.known})
        for a, b in odd:
            # One piece of one token keeps the place of an odd word.
            data[a], data[a + 1 : b] = 33, 10
        kind = self.KIND[data]
        left, right = kind[:-1], kind[1:]
        cuts = np.flatnonzero((left != 0) & (right != 0) & ((left != right) | (right == 2))) + 1
        pieces = np.insert(data, cuts, 10)
        edges = np.flatnonzero(np.diff(pieces != 10, prepend=False))
        begins, ends = edges[::2], edges[1::2]
        ids, sizes = self.pieces.encode(pieces, begins, ends)
        # The token behind the last one of each piece; as many as pieces.
        after = np.concatenate(([0], np.cumsum(sizes)))

        def token(place: np.ndarray) -> np.ndarray:
            """Where the tokens of what begins at these bytes begin."""
            return after[np.searchsorted(begins, place + np.searchsorted(cuts, place, "right"))]

        bounds = token(np.cumsum([0] + [len(p) + 1 for p in parts]))
        if odd:
            where = token(np.array([a for a, _ in odd]))
            own = [self.known[w] for w in words]
            joined, done = [], 0
            for t, x in zip(where.tolist(), own):
                joined += [ids[done:t], x]
                done = t + 1
            ids = np.concatenate([*joined, ids[done:]])
            grown = np.concatenate(([0], np.cumsum([len(x) - 1 for x in own])))
            bounds = bounds + grown[np.searchsorted(where, bounds)]
        raw, size = ids.tobytes(), ids.itemsize
        bounds = (bounds * size).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[memoryview]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        parts: list[bytes] = []
        owner: list[int] = []
        for i, t in enumerate(texts):
            plain = bytes(t)
            try:
                plain.decode()
            except UnicodeDecodeError:
                plain = plain.decode("utf-8", "replace").encode()
            own = [plain] if len(plain) <= 2 * SLICE_BYTES else cut_at_blanks(plain)
            parts += own
            owner += [i] * len(own)
        found: list[list[bytes]] = [[] for _ in texts]
        for first, last in slices([len(p) for p in parts]):
            for i, ids in zip(owner[first:last], self._parts(parts[first:last])):
                found[i].append(ids)
        return [b"".join(f) + self.end for f in found]


def cut_at_blanks(text: bytes) -> list[bytes]:
    """A long text in parts of some ``SLICE_BYTES`` that end between words."""
    blank = re.compile(b"[" + BLANKS + b"]")
    parts, at = [], 0
    while at < len(text):
        found = blank.search(text, at + SLICE_BYTES)
        end = found.start() if found else len(text)
        parts.append(text[at:end])
        at = end
    return parts


class Order:
    """What brings documents with common terms together: weights of terms, directions of documents, and ranks of terms, the least of which chooses one."""

    def __init__(self, idf: np.ndarray):
        hashed = numbered(len(idf), 7)
        self.place = (hashed % np.uint64(SKETCH)).astype(np.int64)
        self.weight = np.where(hashed >> np.uint64(40) & np.uint64(1), 1.0, -1.0) * idf
        #: Numbers per term, the likelier to be small the more it tells, as ranks, and the terms in this order.
        uniform = [((mix(numbered(len(idf), 31 + i)) >> np.uint64(11)) + np.uint64(1)).astype(np.float64) / 2**53 for i in range(3)]
        self.chosen = [np.argsort(-np.log(u) / np.maximum(idf, 1e-6), kind="stable") for u in uniform]
        self.ranks = [np.argsort(c).astype(np.int32) for c in self.chosen]
        self.directions, self.centre = np.zeros((SKETCH, 0)), np.zeros(0)

    def sketches(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One sketch per document, of length ``STEPS``, in whole numbers; documents have one id at least."""
        at = ids.astype(np.intp)
        owner = np.repeat(np.arange(len(sizes)) * SKETCH, sizes)
        out = np.bincount(owner + self.place[at], self.weight[at], len(sizes) * SKETCH).reshape(-1, SKETCH)
        return np.rint(out * (STEPS / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)))

    def learn(self, n: int, total: np.ndarray, products: np.ndarray) -> None:
        """The directions in which sketches differ most, from the sums of all sketches and of their products."""
        mean = total / max(n, 1)
        directions = np.linalg.eigh(products / max(n, 1) - np.outer(mean, mean))[1][:, : -DIRECTIONS - 1 : -1]
        self.directions, self.centre = directions, mean @ directions

    def keys(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per document the sides it is on, then three terms."""
        sides = self.sketches(ids, sizes) @ self.directions > self.centre
        out = sides @ (1 << np.arange(DIRECTIONS)[::-1])
        begins = np.cumsum(sizes) - sizes
        for rank, chosen in zip(self.ranks, self.chosen):
            out = out << 18 | chosen[np.minimum.reduceat(rank[ids], begins)] & 0x3FFFF
        return out


def _documents(column: pa.Array, dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of some documents at a time, one after the other, and how many each has."""
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)
    for first, last in slices(sizes.tolist(), SLICE_BYTES // 2):
        for at in range(first, last, 1000):
            to = min(at + 1000, last)
            yield np.frombuffer(b"".join(x.as_buffer() for x in column.slice(at, to - at)), dtype), sizes[at:to] // np.dtype(dtype).itemsize


def _products(order, dtype):
    """Numbered rows of a matrix: the sums of products of sketches, their sums, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((SKETCH + 2, SKETCH))
        for batch in batches:
            for ids, sizes in _documents(batch.column("ids"), dtype):
                x = order.value.sketches(ids, sizes)
                out[:SKETCH] += x.T @ x
                out[SKETCH] += x.sum(0)
                out[SKETCH + 1, 0] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SKETCH + 2), pa.int32()), pa.array(list(out), pa.list_(pa.float64()))], names=["i", "v"])

    return run


def _keyed(order, dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(0, np.int64), *(order.value.keys(*some) for some in _documents(batch.column("ids"), dtype))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(keys)), batch.column("place"), batch.column("ids")], names=["doc_id", "key", "place", "ids"])

    return run


def _tokenise(definition: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_process(("encoder", hash(definition), end), lambda: Encoder(definition, end))
        counts, place = None, TaskContext.get().partitionId() << 33
        for batch in batches:
            views = byte_views(batch.column("text"))
            for first, last in slices([len(v) for v in views], 4 * SLICE_BYTES):
                ids = encoder.encode(views[first:last])
                for one in ids:
                    own = distinct(np.frombuffer(one, encoder.dtype))
                    if counts is None or own[-1] >= len(counts):
                        grown = np.zeros(max(int(own[-1]) + 1, encoder.vocabulary), np.int64)
                        grown[: 0 if counts is None else len(counts)] = 0 if counts is None else counts
                        counts = grown
                    counts[own] += 1
                n = last - first
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), pa.array(np.arange(place, place + n)), pa.array(ids, pa.binary()), pa.nulls(n, pa.binary())], names=["doc_id", "place", "ids", "frequencies"])
                place += n
        if counts is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, batch.column("doc_id").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["doc_id", "place", "ids", "frequencies"])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column(0):
            own = np.frombuffer(x.as_buffer(), np.int64)
            grown = np.zeros(max(len(own), len(total)), np.int64)
            grown[: len(total)] = total
            grown[: len(own)] += own
            total = grown
    token = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int32)), pa.array(total[token])], names=["token", "n"])


def distinct(ids: np.ndarray) -> np.ndarray:
    """The distinct ids in order (for short integers much faster than numpy's own way)."""
    ids = np.sort(ids)
    new = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    return ids[new]


class Index:
    """BM25 over the token ids of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        found = [np.unique(d[:-1], return_counts=True) for d in docs]
        self.terms = [t for t, _ in found]
        sizes = [len(t) for t in self.terms]
        terms, counts = np.concatenate(self.terms), np.concatenate([c for _, c in found]).astype(np.float32)
        owner = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
        norm = K1 * (1 - B + B * np.array([len(d) - 1 for d in docs], np.float32) / max(mean, 1.0))
        weight = idf[terms] * counts * (K1 + 1) / (counts + norm[owner])
        # A seed asks for all its terms. Those of an eighth of the documents are rows of weights, one column for each document;
        # the postings of the others stand in order of term and document.
        self.query = self.terms
        frequent = np.flatnonzero(np.bincount(terms, minlength=len(idf)) * 8 >= len(docs))
        self.row = np.full(len(idf), -1)
        self.row[frequent] = np.arange(len(frequent))
        row = self.row[terms]
        rows = row >= 0
        self.rows = np.zeros((len(frequent), len(docs)), np.float32)
        self.rows[row[rows], owner[rows]] = weight[rows]
        terms, owner, weight = terms[~rows], owner[~rows], weight[~rows]
        order = np.argsort(terms, kind="stable")
        self.docs, self.weight = owner[order].astype(np.intp), weight[order].astype(np.float64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=len(idf)))))
        #: The documents that are still held, by column.
        self.held = np.arange(len(docs))

    def forget(self, free: np.ndarray) -> None:
        """Leaves out the documents that are not free."""
        keep = free[self.held]
        self.held, self.rows = self.held[keep], np.compress(keep, self.rows, axis=1)  # rows stay contiguous
        stays = keep[self.docs]
        self.first = np.concatenate(([0], np.cumsum(stays)))[self.first]
        self.docs, self.weight = (np.cumsum(keep) - 1)[self.docs[stays]], self.weight[stays]

    def neighbours(self, seed: int, free: np.ndarray, most: int = 64) -> list[int]:
        """The ``most`` best free documents that share a term with the seed, best first; equal scores in order of rows."""
        terms = self.query[seed]
        row = self.row[terms]
        score = self.rows[row[row >= 0]].sum(0)
        rest = terms[row < 0].astype(np.intp)
        if len(rest):
            at = spread(self.first[rest], self.first[rest + 1] - self.first[rest])
            score = score + np.bincount(self.docs[at], self.weight[at], len(score))
        score[~free[self.held]] = 0
        best = np.flatnonzero(score > 0)
        if len(best) > most:
            least = np.partition(score[best], len(best) - most)[len(best) - most]
            above = best[score[best] > least]
            best = np.concatenate([above, best[score[best] == least][: most - len(above)]])
        return self.held[best[np.lexsort((best, -score[best]))]].tolist()


def pack(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces, in order of sequences and offsets."""
    index = Index(docs, idf, mean)
    free = np.ones(len(docs), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    ahead, sequence, used = 0, 0, 0
    held = left = len(docs)
    rest: tuple[int, int] | None = None
    queue: list[int] = []
    seed = -1
    while True:
        if rest is not None:
            doc, start = rest
            seed = doc if used == 0 else seed
        else:
            doc = next((d for d in queue if free[d]), -1)
            if doc < 0 and seed >= 0:
                # The same seed is asked for until no free document shares a term with it.
                queue = index.neighbours(seed, free)
                doc = queue[0] if queue else -1
            if doc < 0:
                while ahead < len(docs) and not free[ahead]:
                    ahead += 1
                if ahead == len(docs):
                    break
                doc = seed = ahead
            start, free[doc], left = 0, False, left - 1
            if left < 0.85 * held:
                index.forget(free)
                held = left
        size = min(len(docs[doc]) - start, window - used)
        pieces.append((doc, start, size, sequence, used))
        used += size
        rest = (doc, start + size) if start + size < len(docs[doc]) else None
        if used == window:
            sequence, used, queue, seed = sequence + 1, 0, [], -1
    if used:
        # The last window is not full: the same ids in sequences of 1024, 512, ... as its length is made up of these.
        last = [p for p in pieces if p[3] == sequence]
        pieces = [p for p in pieces if p[3] != sequence]
        room = [1 << b for b in range(used.bit_length() - 1, -1, -1) if used >> b & 1]
        filled = 0
        for doc, start, size, _, _ in last:
            while size:
                take = min(size, room[0] - filled)
                pieces.append((doc, start, take, sequence, filled))
                start, size, filled = start + take, size - take, filled + take
                if filled == room[0]:
                    room, sequence, filled = room[1:], sequence + 1, 0
    return pieces


def _pack_shards(statistics, window: int, dtype, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = statistics.value
        task = TaskContext.get().partitionId() << 33
        sequences = 0

        def shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal sequences
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            docs = [np.frombuffer(x.as_buffer(), dtype) for b in held for x in b.column("ids")]
            pieces = pack(docs, idf, mean, window)
            doc, start, size, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
            crc = [zlib.crc32(docs[d][s : s + n].astype("<u4").tobytes()) for d, s, n in zip(doc.tolist(), start.tolist(), size.tolist())]
            out = pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)), *map(pa.array, (start, size)), pa.array(crc, pa.int64()), pa.array(np.array([len(d) for d in docs], np.int64)[doc]), pa.array(task + sequences + sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            sequences += int(sequence[-1]) + 1
            return out

        held, tokens = [], 0
        for batch in batches:
            sizes = (pc.binary_length(batch.column("ids")).to_numpy() // np.dtype(dtype).itemsize).tolist()
            first = 0
            for i, n in enumerate(sizes):
                tokens += n
                if tokens >= shard_tokens:
                    yield shard([*held, batch.slice(first, i + 1 - first)])
                    held, tokens, first = [], 0, i + 1
            if first < len(batch):
                held.append(batch.slice(first))
        if held:
            yield shard(held)

    return run


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a definition for the tokenizers library, read by the driver. A document is its
    ids and ``end_id``, so null and empty texts are one id. Every id of every row lies in exactly one piece; repeated rows
    are documents of their own, null ids stay null. An empty table gives an empty result.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    source = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    encoder = Encoder(definition, end_id)
    dtype = encoder.dtype
    staged = scratch.stage(source.mapInArrow(_tokenise(definition, end_id), f"doc_id {kind}, place long, ids binary, frequencies binary"))
    rows = staged.filter("ids is not null").select("doc_id", "place", "ids")
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("ids").cast("long"))).first()
    frequencies = staged.filter("frequencies is not null").select("frequencies").mapInArrow(_sums, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    token, df = frequencies.column("token").to_numpy(), frequencies.column("n").to_numpy()
    known = np.zeros(int(token.max(initial=0)) + 1, np.float64)
    known[token] = df
    idf = np.log1p((n - known + 0.5) / (known + 0.5)).astype(np.float32)
    statistics = spark.sparkContext.broadcast((idf, (total or 0) / np.dtype(dtype).itemsize / max(n, 1)))
    order = spark.sparkContext.broadcast(_learn_order(rows, idf, dtype))
    keyed = rows.mapInArrow(_keyed(order, dtype), f"doc_id {kind}, key long, place long, ids binary")
    near = keyed.repartitionByRange("key", "place").sortWithinPartitions("key", "place").select("doc_id", "ids")
    return near.mapInArrow(_pack_shards(statistics, window, dtype, shard_tokens), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _learn_order(rows: DataFrame, idf: np.ndarray, dtype) -> Order:
    """The order of documents, from one scan over all of them."""
    order = Order(idf.astype(np.float64))
    parts = rows.select("ids").mapInArrow(_products(rows.sparkSession.sparkContext.broadcast(order), dtype), "i int, v array<double>")
    sums = np.zeros((SKETCH + 2, SKETCH))
    for r in parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).collect():
        sums[r["i"]] = r["v"]
    order.learn(int(sums[-1, 0]), sums[SKETCH], sums[:SKETCH])
    return order
