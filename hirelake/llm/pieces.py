r"""Operator 6: SentencePiece encoding and decoding by batched numpy Viterbi.

``encode`` gives each whole text the ids that the model's own library gives it
(no begin or end id), ``decode`` turns ids back into text.

A text is cut into chunks that no piece crosses (a run of spaces and the word
after it); each distinct chunk of a batch is segmented once. Chunks of equal
length advance together: at each end position the hashes of the substrings that
end there probe the sorted hashes of the pieces, and a vectorised maximum over
the candidates stores the backpointer.

What is maximised depends on the model. For a unigram model it is the sum of the
piece scores. A BPE model's merges do not maximise a sum, so there a candidate
counts only if it may follow the state it extends: if merging the two pieces'
text alone gives just these two pieces again. Of the pieces that end at a
position exactly one passes, the last piece of the merged prefix; so the path is
what the merges would give. Whether two pieces stay apart is read off their last
merges: undo the later one of the two, see whether the pieces that then touch would
have merged before it (a merge to the left goes first among equals), and go on to
single characters. All new pairs of a step walk down together, and are remembered.
Chunks led by several spaces are merged by a heap instead: the model ranks longer runs
of spaces before the shorter ones that build them, so their merges are no matter of pairs.

Defined cases: null and empty texts have no id and decode to the empty text; a
character without a piece becomes its UTF-8 byte pieces, and byte pieces decode
together; U+2581 in a text decodes to a space, as in the library; bytes that are
not UTF-8 decode to U+FFFD. Rows, repeated or with null ids, pass through one to
one, extra columns too; an empty table gives an empty result.

Plan: one pass without a shuffle. Each task reads the model file at the path
given; remembered chunks and pairs are bounded and then forgotten. ``encode`` and
``decode`` one after the other would need two Python workers a task, each with the
model; ``encode_decode`` does both in one.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from hirelake.llm.common import mix, read, small_batches, tidy

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MEMO_CHUNKS = 200_000
MEMO_PAIRS = 21           # places for remembered pairs, a power of two
GROUP = 1 << 16           # characters of chunks that advance together, at most
_BASE = np.uint64(0xD1342543DE82EF95)
_LEAD = 18                # leading bits of a hash by which pieces are found
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """A model's pieces and the segmentation of texts into them."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.kind, self.unk = kind, model.unk_id()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i)
                                             or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.score = np.array([model.get_score(i) for i in range(n)])
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i
                         for i in range(n) if model.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.spelled = self._spell(byte_of, plain)
        self.longest = max(map(len, self.ids))
        keys = mix(np.array([self._hash(p) for p in self.ids], dtype=np.uint64))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ids = np.array(list(self.ids.values()), dtype=np.int64)[order]
        # where the search among the sorted keys begins, by a hash's leading bits
        self.begin = np.searchsorted(self.keys, np.arange(1 << _LEAD, dtype=np.uint64)
                                     << np.uint64(64 - _LEAD)).astype(np.int32)
        self.steps = int(np.diff(np.append(self.begin, len(keys))).max())
        self.keys = np.append(self.keys, np.full(self.steps, ~np.uint64(0)))
        self.key_ids = np.append(self.key_ids, np.full(self.steps, -1))
        self.lengths = np.array([len(p) for p in self.names], dtype=np.int64)
        self.hashes = np.array([self._hash(p) for p in self.names], dtype=np.uint64)
        self.power = np.cumprod(np.array([1] + [int(_BASE)] * self.longest, dtype=np.uint64))
        order = np.argsort(-self.score, kind="stable")
        self.rank = np.empty(n, dtype=np.int64)         # of a merge; the best first
        self.rank[order] = np.arange(n)
        self.rank[self.lengths == 1] = -1
        self.left = np.full(n, -1, dtype=np.int64)      # last merge; the piece itself: none
        self.right = np.full(n, -1, dtype=np.int64)
        self.whole = np.zeros(n, dtype=bool)            # do merges give the piece at all?
        self.first = n                      # state codes: n = start, n + 1 = unknown
        self.width = n + 2
        self.pair_codes: np.ndarray | None = None       # decoding needs no pairs
        self.pair_fits: np.ndarray | None = None
        self.memo: dict[str, bytes] = {}
        probe = "Ａ ﬁ  x \t\ny "
        self.plain_text = model.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.normalize = model.normalize

    def _spell(self, byte_of, plain) -> list[bytes]:
        out = [byte_of.get(i, b"") for i in range(len(self.names))]
        for i in plain:
            out[i] = self.names[i].replace(SPACE, " ").encode()
        out[self.unk] = " ⁇ ".encode()
        return out

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
        return h

    # --- merges, one chunk at a time -------------------------------------------

    def merged(self, chunk: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces that BPE merges leave (best score first, then leftmost), and
        what the last merge joined."""
        parts: list[str | None] = list(chunk)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []
        last = None

        def offer(i: int, j: int) -> None:
            both = parts[i] + parts[j]
            piece = self.ids.get(both)
            if piece is not None:
                heapq.heappush(heap, (-self.score[piece], i, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[j] is None or parts[i] + parts[j] != both:
                continue
            last = parts[i], parts[j]
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None], last

    def _split(self, pieces: np.ndarray) -> None:
        """Learn the last merges of pieces, and of what they merge."""
        todo = pieces[self.left[pieces] < 0].tolist()
        while todo:
            i = todo.pop()
            if self.left[i] >= 0:
                continue
            left, last = self.merged(self.names[i])
            self.whole[i] = left == [self.names[i]]
            self.left[i] = self.right[i] = i
            if self.whole[i] and last:
                self.left[i], self.right[i] = self.ids[last[0]], self.ids[last[1]]
                todo += [int(self.left[i]), int(self.right[i])]

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        """Pieces by hash, -1 for none."""
        h = mix(h)
        at = self.begin[h >> np.uint64(64 - _LEAD)]
        found = np.full(h.shape, -1, dtype=np.int64)
        for step in range(self.steps):
            hit = self.keys[at + step] == h
            found[hit] = self.key_ids[(at + step)[hit]]
        return found

    def _apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Do the merges of the text of pieces x and y give just x and y?"""
        self._split(np.unique(np.concatenate([x, y])))
        out = self.whole[x] & self.whole[y]
        live = np.flatnonzero(out)
        x, y = x[live], y[live]
        limit = np.full(len(live), len(self.names) + 1, dtype=np.int64)
        while len(live):
            short = self.lengths[x] + self.lengths[y] <= self.longest
            both = np.where(short, self._lookup(
                self.hashes[x] * self.power[np.where(short, self.lengths[y], 0)] + self.hashes[y]), -1)
            joins = (both >= 0) & (self.rank[both] < limit)
            undo_x = self.rank[x] > self.rank[y]
            ends = ~undo_x & (self.rank[y] < 0)          # two single characters
            out[live[joins]] = False
            limit = np.where(undo_x, self.rank[x], self.rank[y] + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            go = ~joins & ~ends
            live, x, y, limit = live[go], x[go], y[go], limit[go]
        return out

    def _fits(self, codes: np.ndarray) -> np.ndarray:
        """May the piece follow the state? For each code state * width + piece."""
        if self.pair_codes is None:
            self.pair_codes = np.full(1 << MEMO_PAIRS, -1, dtype=np.int64)
            self.pair_fits = np.zeros(1 << MEMO_PAIRS, dtype=bool)
        slot = (codes.astype(np.uint64) * _BASE >> np.uint64(64 - MEMO_PAIRS)).astype(np.int64)
        out = self.pair_fits[slot]
        missed = np.flatnonzero(self.pair_codes[slot] != codes)
        if len(missed):
            new, where = np.unique(codes[missed], return_inverse=True)
            state, piece = np.divmod(new, self.width)
            self._split(np.unique(piece))
            fits = self.whole[piece]
            inner = np.flatnonzero(state < self.first)
            fits[inner] = self._apart(state[inner], piece[inner])
            out[missed] = fits[where]
            place = slot[missed[np.unique(where, return_index=True)[1]]]
            # of pairs that share a place one stays, with its own answer
            self.pair_codes[place] = new
            kept = self.pair_codes[place] == new
            self.pair_fits[place[kept]] = fits[kept]
        return out

    # --- Viterbi, equal lengths together -----------------------------------------

    def _segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks of one length, joined, and where each ends; -1 - code point
        stands for an unknown character."""
        m, n = len(chunks), len(chunks[0])
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"),
                               dtype=np.uint32).reshape(m, n)
        sums = np.zeros((n + 1, m), dtype=np.uint64)
        for j in range(n):
            sums[j + 1] = sums[j] * _BASE + points[:, j] + np.uint64(1)
        pieces_at = np.full((n + 1, min(self.longest, n), m), -1, dtype=np.int32)
        for l in range(1, min(self.longest, n) + 1):     # the piece of l characters up to j
            pieces_at[l:, l - 1] = self._lookup(sums[l:] - sums[:-l] * self.power[l])
        state = np.full((n + 1, m), self.first, dtype=np.int64)
        taken = np.zeros((n + 1, m), dtype=np.int64)      # length of the last piece
        total = np.full((n + 1, m), 0.0)
        floor = self.score.min() - 10.0
        for j in range(1, n + 1):
            most = min(self.longest, j)
            found = pieces_at[j, :most].astype(np.int64)
            unknown = found[0] < 0
            if self.kind == "unigram":
                gain = np.full((most, m), -np.inf)
                for l in range(1, most + 1):
                    ok = found[l - 1] >= 0
                    gain[l - 1][ok] = total[j - l][ok] + self.score[found[l - 1][ok]]
                gain[0][unknown] = total[j - 1][unknown] + floor
            else:
                gain = (found >= 0).astype(float)
                several = gain.sum(axis=0) + unknown > 1
                rows, cols = np.nonzero((found >= 0) & several)
                codes = state[j - 1 - rows, cols] * self.width + found[rows, cols]
                gain[rows, cols] = 2.0 * self._fits(codes)
                gain[0][unknown] = np.maximum(gain[0][unknown], 0.5)
            best = gain.argmax(axis=0)
            column = np.arange(m)
            total[j] = gain[best, column]
            piece = found[best, column]
            state[j] = np.where(piece >= 0, piece, self.first + 1)
            taken[j] = best + 1
        # the way back, last piece first, for all chunks at once
        marks, at, live = [], np.full(m, n), np.arange(m)
        count = np.zeros(m, dtype=np.int64)
        while len(live):
            ends = at[live]
            piece = state[ends, live]
            marks.append((live, np.where(
                piece > self.first, -1 - points[live, ends - 1].astype(np.int64), piece)))
            count[live] += 1
            at[live] = ends - taken[ends, live]
            live = live[at[live] > 0]
        stop = np.cumsum(count)
        flat = np.empty(stop[-1] if m else 0, dtype=np.int64)
        for k, (live, piece) in enumerate(marks):
            flat[stop[live] - 1 - k] = piece
        return flat, stop

    def _spelt(self, flat: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """Final ids of each chunk, unknown characters as byte pieces."""
        odd = np.flatnonzero(flat < 0)
        if len(odd):
            size = np.ones(len(flat), dtype=np.int64)
            spelt = [[self.byte_ids[b] for b in chr(-1 - c).encode("utf-8", "replace")]
                     if self.byte_ids else [self.unk] for c in flat[odd].tolist()]
            size[odd] = [len(x) for x in spelt]
            ends = np.cumsum(size)
            out = np.repeat(flat, size)
            for i, x in zip((ends - size)[odd].tolist(), spelt):
                out[i:i + len(x)] = x
            flat, stop = out, ends[stop - 1]
        data = flat.astype("<i4").tobytes()
        stops = (4 * stop).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def _learn(self, chunks: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for c in chunks:
            if c not in self.memo:
                if self.kind == "bpe" and c.startswith(SPACE * 2):
                    ids = np.array([self.ids.get(p, -1 - ord(p[0])) for p in self.merged(c)[0]])
                    self.memo[c] = self._spelt(ids, np.array([len(ids)]))[0]
                else:
                    by_length.setdefault(len(c), []).append(c)
        for length, group in by_length.items():
            step = max(1, GROUP // length)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                self.memo.update(zip(part, self._spelt(*self._segment(part))))

    def _cut(self, text: str) -> list[str]:
        """The chunks of a text."""
        if not text:
            return []
        if not self.plain_text:
            return _CHUNK.findall(self.normalize(text))
        words = text.split(" ")
        if "" in words or SPACE in text:
            return _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return [SPACE + w for w in words]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts are cut twice, so that the chunks of one are held
        at a time, and of all only those to learn."""
        if len(self.memo) > MEMO_CHUNKS:
            self.memo.clear()
        new: set[str] = set()
        for t in texts:
            new.update(itertools.filterfalse(self.memo.__contains__, self._cut(t)))
        self._learn(new)
        new.clear()
        get = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(get, self._cut(t))), dtype="<i4") for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[tuple[str, str], Pieces] = {}


def pieces(path: str, kind: str = "bpe") -> Pieces:
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Pieces(path, kind)
    return _loaded[path, kind]


def _parts(texts: list[str | None], chars: int = 1 << 22) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        part.append(t or "")
        held += len(part[-1])
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


_IDS, _TEXT = ArrayType(IntegerType()), StringType()


def _encoder(path: str, kind: str, place: int, name: str):
    """Batches with the ids of their texts as one column more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            ids = [x for part in _parts(batch.column(place).to_pylist()) for x in model.encode(part)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            del ids, ends, flat
            yield pa.RecordBatch.from_arrays([*batch.columns, lists],
                                             names=[*batch.schema.names, name])
        model.memo.clear()         # the worker may live on, idle
    return run


def _decoder(path: str, kind: str, place: int, name: str):
    """Batches with the text of their ids as one column more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            texts = [model.decode(np.array(x.values.to_numpy() if x.is_valid else [], dtype=int))
                     for x in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])
    return run


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text",
           ids_col: str = "token_ids", kind: str = "bpe") -> DataFrame:
    """``docs`` with the ids of its texts as an array column (replaced if there)."""
    path = path or public_tokenizers.path(MODEL)
    small_batches(docs.sparkSession, 1000)
    rest = docs.drop(ids_col)
    task = _encoder(path, kind, rest.columns.index(text_col), ids_col)
    return rest.mapInArrow(tidy(task), StructType([*rest.schema.fields, StructField(ids_col, _IDS)]))


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "token_ids",
           out_col: str = "decoded", kind: str = "bpe") -> DataFrame:
    """``rows`` with the text of its ids (null ids: empty text)."""
    path = path or public_tokenizers.path(MODEL)
    small_batches(rows.sparkSession, 1000)
    rest = rows.drop(out_col)
    task = _decoder(path, kind, rest.columns.index(ids_col), out_col)
    return rest.mapInArrow(tidy(task), StructType([*rest.schema.fields, StructField(out_col, _TEXT)]))


def encode_decode(docs: DataFrame, path: str | None = None, text_col: str = "text",
                  ids_col: str = "token_ids", out_col: str = "decoded",
                  kind: str = "bpe") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task: each batch is encoded, and
    the ids it gets are decoded."""
    path = path or public_tokenizers.path(MODEL)
    small_batches(docs.sparkSession, 1000)
    rest = docs.drop(ids_col, out_col)
    encoder = _encoder(path, kind, rest.columns.index(text_col), ids_col)
    decoder = _decoder(path, kind, len(rest.columns), out_col)
    schema = StructType([*rest.schema.fields, StructField(ids_col, _IDS), StructField(out_col, _TEXT)])
    return rest.mapInArrow(tidy(lambda batches: decoder(encoder(batches))), schema)


def run(spark, sf_dir) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256`` (ids as text, comma-joined),
    ``decoded_sha256, round_trip`` of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode_decode(docs)
    return back.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


SQL = None
