"""SentencePiece encoding and decoding by a max-plus scan over the pieces of a BPE model.

A segmentation is a path over states (end, last piece). A step to the next piece weighs 0 if
merging the two pieces' characters would give just these two, else minus infinity. BPE's own
segmentation is the only path of weight 0: the first merge across a border of two of its
pieces would also come first if only those two were merged, so every neighbouring pair holds;
and two paths that hold pairwise cannot differ. The best path is thus what the library gives.

A giant text is cut into chunks. Each yields the max-plus matrix from the states at its left
border to those at its right one. Matrices are combined associatively, which fixes the state
at every border, and the path inside each chunk is then traced back on its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import free_name, slices, stored, text_bytes
from envlake.llm.tokens import SLICE, PieceMemo, kept

CHUNK = 32_768  # characters; longer texts are scanned in chunks
MOST_PAIRS = 500_000  # remembered; all are forgotten when there are more
NEVER = -np.inf
CUT = ""  # the state at a border that no piece of the model spans


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceBytes:
    """The bytes that each id of a model stands for; control ids stand for none."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        data = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                data.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                data.append(b"")
            else:
                data.append(piece.replace("▁", " ").encode())
        self.length = np.fromiter(map(len, data), np.int64, len(data))
        self.start = np.cumsum(self.length) - self.length
        self.arena = np.frombuffer(b"".join(data), np.uint8)

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each stretch of ids, without the blank that encoding put in front."""
        length = self.length[ids]
        before = np.cumsum(length) - length
        places = np.repeat(self.start[ids] - before, length) + np.arange(int(length.sum()))
        data = self.arena[places].tobytes()
        edges = np.r_[0, np.cumsum(length)][offsets].tolist()
        return [data[a + 1 : b].decode("utf-8", "replace") if b > a else "" for a, b in zip(edges, edges[1:], strict=False)]


class Lattice(PieceMemo):
    """Pieces of a model, which pairs may follow each other, and paths over them.

    A blank stands for the model's white-space mark in all texts here.
    """

    most = 400_000

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" a  Å ") != "▁▁a▁▁Å▁":
            raise ValueError("only models without text normalisation, with a leading blank, are supported")
        self.number: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                self.number[text], self.score[text] = i, model.get_score(i)
        self.longest = max(map(len, self.number))
        self.pairs: dict[int, bool] = {}
        # characters that stand next to each other inside some piece
        chars = sorted({c for p in self.number for c in p})
        self.char = np.zeros(0x110000, np.uint16)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.number:
            codes = self.char[[ord(c) for c in p]]
            self.joined[codes[:-1], codes[1:]] = True

    def merged(self, text: str) -> list[str]:
        """BPE of a short text as the model defines it: the best-scored pair first, then the leftmost."""
        parts, get = list(text), self.score.get
        scores = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return parts

    def weight(self, last: str, piece: str) -> float:
        """0 or minus infinity, for ``piece`` after ``last``; after CUT any piece BPE makes."""
        left, right = self.number.get(last, 0), self.number.get(piece, 0)
        if not right or (last and not left):
            return 0.0  # a character without a piece merges with nothing
        known = self.pairs.get(left << 20 | right)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.merged(last + piece) == ([last, piece] if last else [piece])
            self.pairs[left << 20 | right] = known
        return 0.0 if known else NEVER

    def steps(self, text: str, at: int) -> Iterator[str]:
        yield text[at]  # also a character without a piece
        for n in range(2, min(self.longest, len(text) - at) + 1):
            if text[at : at + n] in self.number:
                yield text[at : at + n]

    def reach(self, text: str, entries: Sequence[tuple[int, str]], stop: int) -> dict[tuple[int, str], dict[int, float]]:
        """Weights of the best paths from each entry to the states whose piece begins before ``stop``.

        States are (end, last piece); the result holds those that end at ``stop`` or beyond.
        """
        at_end: dict[int, dict[str, dict[int, float]]] = {}
        for i, (end, last) in enumerate(entries):
            at_end.setdefault(end, {}).setdefault(last, {})[i] = 0.0
        out = {}
        for at in range(min(e for e, _ in entries), stop):
            for last, rows in at_end.pop(at, {}).items():
                for piece in self.steps(text, at):
                    w = self.weight(last, piece)
                    if w > -np.inf:
                        to = at_end.setdefault(at + len(piece), {}).setdefault(piece, {})
                        for i, v in rows.items():
                            to[i] = max(to.get(i, -np.inf), v + w)
        for end, states in at_end.items():
            for last, rows in states.items():
                out[end, last] = rows
        return out

    def path(self, text: str, entry: tuple[int, str], goal: tuple[int, str] | None = None) -> list[str]:
        """Pieces after ``entry`` on the path to ``goal``, or to the end of the text."""
        best: dict[int, dict[str, str]] = {entry[0]: {entry[1]: ""}}
        end = goal[0] if goal else len(text)
        for at in range(entry[0], end):
            for last in best.get(at, ()):
                for piece in self.steps(text, at):
                    if at + len(piece) <= end and self.weight(last, piece) > -np.inf:
                        best.setdefault(at + len(piece), {})[piece] = last
        at = end
        if at == entry[0]:
            return []
        last = goal[1] if goal else next(iter(best[at]))
        out = []
        while at > entry[0]:
            out.append(last)
            at, last = at - len(last), best[at][last]
        return out[::-1]

    def numbers(self, pieces: Sequence[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.number.get(p)
            if i is None:
                out.extend(self.byte[b] for b in p.encode())
            else:
                out.append(i)
        return out

    def unit(self, text: str) -> list[str]:
        """The best path over a text between two cuts.

        Every prefix has one path of weight 0, so one state per place is kept: the first piece
        found whose step weighs 0 is the maximum.
        """
        get, pairs, longest = self.number.get, self.pairs, self.longest
        last: list[str] = [""] * (len(text) + 1)
        code = [0] * (len(text) + 1)  # number of the last piece, -1 for a character without one
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - longest), end):
                piece = text[start:end]
                right = get(piece)
                if right is None:
                    if end - start > 1:
                        continue
                    last[end], code[end] = piece, -1
                    break
                left = code[start]
                if left < 0:
                    fits = self.weight("", piece) == 0.0
                else:
                    fits = pairs.get(left << 20 | right)
                    if fits is None:
                        fits = self.weight(last[start], piece) == 0.0
                if fits and (left or not start):
                    last[end], code[end] = piece, right
                    break
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def fresh(self, wanted: list[str]) -> dict[str, bytes]:
        return {w: np.array(self.numbers(self.unit(w)), "<u4").tobytes() for w in wanted}

    def spans(self, text: str) -> np.ndarray:
        """For each place between two characters, and both ends, whether a piece may span it."""
        if not text:
            return np.zeros(1, bool)
        codes = self.char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return np.r_[False, self.joined[codes[:-1], codes[1:]], False]

    def encode_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that begin and end at cuts, and the number of ids of each text."""
        raw, offsets = text_bytes(texts)
        heads = np.flatnonzero((raw & 0xC0) != 0x80)
        if not len(heads):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        codes = self.char[points]
        open_ = np.r_[True, ~self.joined[codes[:-1], codes[1:]]]
        open_[np.searchsorted(heads, offsets[:-1][offsets[:-1] < len(raw)])] = True
        starts = heads[open_]
        ends = np.append(starts[1:], len(raw))
        ids, length = self.ids(raw, starts, ends)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        return ids, np.bincount(owner, weights=length, minlength=len(offsets) - 1).astype(np.int64)


def lattice(path: str) -> Lattice:
    return kept(Lattice, path)


def prepared(text: str) -> str:
    """The text as the model sees it, with a leading blank; an empty one stays empty."""
    return " " + text.replace("▁", " ") if text else ""


# --- chunks -------------------------------------------------------------------------------


def label(offset: int, piece: str) -> str:
    """A border state: a piece that begins before the border and ends ``offset`` after it."""
    return json.dumps([offset, piece]) if piece else CUT


def entries_at(model: Lattice, text: str, border: int, spans: np.ndarray) -> dict[str, tuple[int, str]]:
    """All states that a path may have at a border, by label."""
    if not spans[border]:
        return {CUT: (border, CUT)}
    out = {}
    for start in range(max(0, border - model.longest), border):
        for piece in model.steps(text, start):
            end = start + len(piece)
            if end >= border:
                out[label(end - border, piece)] = (end, piece)
    return out


class Chunk:
    """A stretch of a text between two borders, with the context that pieces may reach into."""

    def __init__(self, model: Lattice, left: str, body: str, right: str):
        self.model, self.text = model, left + body + right
        self.low, self.high = len(left), len(left) + len(body)
        self.spans = model.spans(self.text)
        cuts = np.flatnonzero(~self.spans[self.low : self.high + 1]) + self.low
        self.first, self.last = (int(cuts[0]), int(cuts[-1])) if len(cuts) else (None, None)
        self.entries = entries_at(model, self.text, self.low, self.spans)

    def matrix(self) -> tuple[list[str], list[str], np.ndarray]:
        """Labels of the rows (left border) and columns (right border), and the weights."""
        names, states = list(self.entries), list(self.entries.values())
        if self.first is None:
            found = self.model.reach(self.text, states, self.high)
            exits = {label(end - self.high, piece): rows for (end, piece), rows in found.items()}
        else:
            before = {}
            if self.first > self.low:
                for (end, _), rows in self.model.reach(self.text, states, self.first).items():
                    if end == self.first:
                        before.update(rows)
            else:
                before = {i: 0.0 for i, (end, _) in enumerate(states) if end == self.first}
            after: dict[str, float] = {CUT: 0.0}
            if self.last < self.high:
                after = {label(end - self.high, piece): rows[0] for (end, piece), rows in self.model.reach(self.text, [(self.last, CUT)], self.high).items()}
            exits = {name: {i: v + w for i, v in before.items()} for name, w in after.items()}
        weights = np.full((len(names), len(exits)), -np.inf)
        for c, rows in enumerate(exits.values()):
            for r, v in rows.items():
                weights[r, c] = v
        return names, list(exits), weights

    def ids(self, entry: str, exit_: str) -> np.ndarray:
        """Ids of the pieces that begin in the chunk, on the path between two border states."""
        model, text = self.model, self.text
        state = self.entries[entry]
        if exit_ == CUT:
            goal = None
        else:
            offset, piece = json.loads(exit_)
            goal = (self.high + offset, piece)
        if self.first is None:
            pieces = model.path(text, state, goal) if goal else model.path(text[: self.high], state)
            return np.array(model.numbers(pieces), np.uint32)
        head = model.path(text[: self.first], state)
        middle, _ = model.encode_units(pa.array([text[self.first : self.last]]))
        tail = model.path(text, (self.last, CUT), goal) if goal else []
        return np.concatenate([np.array(model.numbers(head), np.uint32), middle, np.array(model.numbers(tail), np.uint32)])


Matrix = tuple[list[str], list[str], np.ndarray]


def max_plus(a: Matrix, b: Matrix) -> Matrix:
    """Product in the max-plus semiring, over the states at the common border; associative."""
    place = {name: i for i, name in enumerate(b[0])}
    common = [(i, place[name]) for i, name in enumerate(a[1]) if name in place]
    weights = np.full((len(a[0]), len(b[1])), -np.inf)
    for i, j in common:
        weights = np.maximum(weights, a[2][:, i, None] + b[2][None, j, :])
    return a[0], b[1], weights


def border_states(matrices: Sequence[Matrix], entry: str = CUT, exit_: str = CUT) -> list[str]:
    """The state at each of the n + 1 borders on the best path from ``entry`` to ``exit_``.

    Products of the matrices before a border are combined with the one after it, then borders
    are fixed from the right.
    """
    rows, columns, weights = matrices[0]
    prefixes: list[Matrix] = [([entry], columns, weights[rows.index(entry) :][:1])]
    for m in matrices[1:]:
        prefixes.append(max_plus(prefixes[-1], m))
    states = [exit_]
    for k in range(len(matrices) - 1, 0, -1):
        rows, columns, weights = matrices[k]
        into = {n: w for n, w in zip(prefixes[k - 1][1], prefixes[k - 1][2][0], strict=True)}
        column = columns.index(states[-1])
        best = max(range(len(rows)), key=lambda r: into.get(rows[r], -np.inf) + weights[r, column])
        if into.get(rows[best], -np.inf) + weights[best, column] == -np.inf:
            raise ValueError("no segmentation")
        states.append(rows[best])
    return [entry, *states[::-1]]


def combined(matrices: Sequence[Matrix]) -> Matrix:
    """The matrix of a stretch from those of its parts, in order."""
    return reduce(max_plus, matrices)


TOGETHER = 64  # matrices that one task combines
MATRIX = "row long, chunk int, rows array<string>, columns array<string>, weights array<double>"


# --- Spark --------------------------------------------------------------------------------


def _whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in slices(batches, "text", SLICE):
            texts = pa.array([prepared(t) for t in batch.column("text").to_pylist()], pa.string())
            ids, counts = model.encode_units(texts)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            yield pa.record_batch({
                "id": batch.column("id"),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
            })

    return run


def _chunks(chunk: int, context: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, row, raw in zip(batch.column("id"), batch.column("row").to_pylist(), batch.column("text"), strict=True):
                text = prepared(raw.as_py())
                for low in range(0, len(text), chunk * 64):  # some chunks in a batch
                    starts = range(low, min(low + chunk * 64, len(text)), chunk)
                    yield pa.record_batch({
                        "id": pa.array([id_.as_py()] * len(starts), batch.schema.field("id").type),
                        "row": pa.array([row] * len(starts), pa.int64()),
                        "chunk": pa.array([s // chunk for s in starts], pa.int32()),
                        "left": pa.array([text[max(0, s - context) : s] for s in starts], pa.string()),
                        "body": pa.array([text[s : s + chunk] for s in starts], pa.string()),
                        "right": pa.array([text[s + chunk : s + chunk + context] for s in starts], pa.string()),
                    })

    return run


def _matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in slices(batches, "body"):
            parts = (batch.column(c).to_pylist() for c in ("left", "body", "right"))
            found = [Chunk(model, *p).matrix() for p in zip(*parts, strict=True)]
            yield pa.record_batch({"row": batch.column("row"), "chunk": batch.column("chunk"), **_columns(found)})

    return run


def _columns(matrices: Sequence[Matrix]) -> dict[str, pa.Array]:
    return {
        "rows": pa.array([m[0] for m in matrices], pa.list_(pa.string())),
        "columns": pa.array([m[1] for m in matrices], pa.list_(pa.string())),
        "weights": pa.array([m[2].ravel().tolist() for m in matrices], pa.list_(pa.float64())),
    }


def _in_order(table: pa.Table) -> tuple[pa.Table, list[Matrix]]:
    """Parts of one stretch of a text by their place, and their matrices."""
    table = table.sort_by("chunk")
    columns = (table.column(c).to_pylist() for c in ("rows", "columns", "weights"))
    return table, [(r, c, np.array(w).reshape(len(r), len(c))) for r, c, w in zip(*columns, strict=True)]


def _product(table: pa.Table) -> pa.Table:
    """One matrix for a stretch of chunks, whose place is that of the stretch."""
    table, matrices = _in_order(table)
    return pa.table({"row": table.column("row")[:1], "chunk": table.column("stretch")[:1], **_columns([combined(matrices)])})


def _borders(table: pa.Table) -> pa.Table:
    """The states at the borders of a stretch's parts, given those at its own ends."""
    table, matrices = _in_order(table)
    states = border_states(matrices, table.column("entry")[0].as_py(), table.column("exit")[0].as_py())
    return pa.table({
        "row": table.column("row"), "chunk": table.column("chunk"),
        "entry": pa.array(states[:-1], pa.string()), "exit": pa.array(states[1:], pa.string()),
    })


def scanned(matrices: DataFrame, most: int) -> DataFrame:
    """(row, chunk, entry, exit) of each of at most ``most`` chunks of every text, from their matrices.

    A parallel scan: products of stretches of ``TOGETHER`` chunks, then of as many stretches, and so
    on, until a text has few; states at the borders of the longest stretches are fixed first,
    then inside each, down to the chunks. A task holds ``TOGETHER`` matrices at most.
    """
    states = "row long, chunk int, entry string, exit string"
    levels = [matrices]
    while most > TOGETHER:
        levels[-1] = stored(levels[-1], "matrices")
        stretches = levels[-1].withColumn("stretch", F.floor(F.col("chunk") / TOGETHER).cast("int"))
        levels.append(stretches.groupBy("row", "stretch").applyInArrow(_product, MATRIX))
        most = -(-most // TOGETHER)
    ends = {"entry": F.lit(CUT), "exit": F.lit(CUT)}
    known = levels[-1].withColumns(ends).groupBy("row").applyInArrow(_borders, states)
    for parts in levels[-2::-1]:
        above = known.withColumnRenamed("chunk", "stretch")
        parts = parts.withColumn("stretch", F.floor(F.col("chunk") / TOGETHER).cast("int")).join(above, ["row", "stretch"])
        known = parts.groupBy("row", "stretch").applyInArrow(_borders, states)
    return known


def _traced(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(path)
        for batch in slices(batches, "body"):
            columns = [batch.column(c).to_pylist() for c in ("left", "body", "right", "entry", "exit")]
            ids = [Chunk(model, a, b, c).ids(d, e) for a, b, c, d, e in zip(*columns, strict=True)]
            yield pa.record_batch({
                "id": batch.column("id"), "row": batch.column("row"), "chunk": batch.column("chunk"),
                "ids": pa.array(ids, pa.list_(pa.int32())),
            })

    return run


Batches = Iterator[pa.RecordBatch]


def encode_pieces(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    model: str | None = None,
    chunk: int = CHUNK,
    finish: tuple[Callable[[Batches], Batches], str] | None = None,
) -> DataFrame:
    """(``id_col``, ``ids``) of every row: the ids that the model gives its whole text.

    Null and empty texts have no ids. Repeated and null ids are allowed; other columns are not
    returned, whatever their names. An empty table gives an empty one. Texts of more than
    ``chunk`` characters are cut into chunks, which are spread over tasks: a task holds some
    chunks, the matrices of some neighbouring stretches (:func:`scanned`), and the ids of a text.

    ``finish``, a function of batches with ``id`` and ``ids`` and the schema it returns, is
    applied where ids are made, so that they need not travel to another Python worker.
    """
    path = model or default_model()
    context = lattice(path).longest
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = F.char_length("text")
    encode, schema = _whole(path), f"id {id_type}, ids array<int>"
    if finish:
        last, schema = finish
        encode = lambda batches, first=encode: last(first(batches))
    short = rows.where(size < chunk).mapInArrow(encode, schema)
    cut = stored(
        rows.where(size >= chunk).withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _chunks(chunk, context), f"id {id_type}, row long, chunk int, left string, body string, right string"
        ),
        "chunks",
    )
    spread = cut.repartition("row", "chunk")  # chunks of one text go to different tasks
    most = cut.agg(F.max("chunk")).first()[0]
    borders = scanned(spread.mapInArrow(_matrices(path), MATRIX), 0 if most is None else most + 1)
    traced = spread.join(borders, ["row", "chunk"]).mapInArrow(
        _traced(path), f"id {id_type}, row long, chunk int, ids array<int>"
    )
    long_ = traced.groupBy("row").agg(
        F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts")
    )
    whole = long_.select("id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    if finish:
        return short.unionByName(whole.mapInArrow(*finish))
    return short.unionByName(whole).withColumnRenamed("id", id_col)


def decoded_batches(path: str, name: str = "text"):
    """Batches with a list column ``ids`` to the same with their texts as a further column.

    Steps after it in one function share its Python worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(PieceBytes, path)
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, 256):
                some = offsets[at : at + 257]
                texts = model.texts(ids[some[0] : some[-1]], some - some[0])
                part = batch.slice(at, len(some) - 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return run


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and the ``text`` of its ``ids``; null ids give the empty text.

    The white-space mark itself comes back as a blank, all other texts as they were.
    """
    name = free_name(encoded.columns, "text")
    path = model or default_model()
    rows = encoded.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    return rows.mapInArrow(decoded_batches(path, name), encoded.schema.add(name, "string"))
