"""Exact token counts of every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

TOKENIZER = "word_bpe_49k.json"
# Words, pieces of words, prefixes of pieces and pairs of tokens that a worker remembers, all of at most so many letters.
WORDS, PIECES, PREFIXES, PAIRS = 200_000, 400_000, 600_000, 500_000
REMEMBERED_LENGTH = 48
# Contractions that the vocabulary's word pattern keeps in one piece.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PATTERN = regex.compile(r"\s+|" + "|".join(CONTRACTIONS) + r"|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
BLANKS = regex.compile(r"\s")
# Texts with these, or not in normal form, go character by character: the first letter becomes
# two when lower-cased, the others may be younger than a library's tables.
UNUSUAL = regex.compile("[İᲉᲊꟀ-ꟿ\U00010000-\U0001efff\U00020000-\U0010ffff]")
LETTER, NUMBER, MARK, BLANK = range(4)
ONE = (1,)
TABLE = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, width int, steps binary"


def byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next one beyond 255."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in prints else chr(next(spare)) for b in range(256)}


class _After(dict):
    """Which tokens stay apart from the token before them."""

    def __init__(self, merges: Merges, before: str, closed: bool):
        self.merges, self.before, self.end = merges, before, merges.end if closed else ""

    def __missing__(self, token: str) -> bool:
        found = not self.before or self.merges.apart(self.before, token + self.end)
        if self.merges.remembered < PAIRS:
            self.merges.remembered += 1
            self[token] = found
        return found


class Merges:
    """Tokens of a byte-pair vocabulary whose words end in a marked symbol.

    A row of tokens is the encoding of a word exactly if all its neighbours stay apart,
    that is, if the merges leave each two of them as they are.
    """

    NEVER = 1 << 62

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.end = told["model"]["end_of_word_suffix"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(told["model"]["merges"])}
        self.parts = {a + b: (a, b) for a, b in self.ranks}
        self.edges: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.specials = [t["content"] for t in told["added_tokens"]]
        whole = [t for t in told["model"]["vocab"] if len(self.merged(self.symbols(t))) == 1]
        self.open = {t for t in whole if not t.endswith(self.end)}
        self.closed = {t[: -len(self.end)] for t in whole if t.endswith(self.end)}
        self.open_sizes, self.closed_sizes = self._sizes(self.open), self._sizes(self.closed)
        self.longest = max(map(len, self.open | self.closed))
        self.remembered, self.after = 0, {"": self._follow("")}

    def _follow(self, token: str) -> tuple[_After, _After]:
        return _After(self, token, False), _After(self, token, True)

    def followers(self, token: str) -> tuple[_After, _After]:
        if token not in self.after:
            self.after[token] = self._follow(token)
        return self.after[token]

    @staticmethod
    def _sizes(tokens: set[str]) -> dict[str, tuple[int, ...]]:
        """Lengths, longest first, of the tokens that a string with these last two or three letters may end in."""
        found: dict[str, set[int]] = {}
        for t in tokens:
            for last in (2, 3):
                if len(t) >= last:
                    found.setdefault(t[-last:], {1}).add(len(t))
        for ending, sizes in found.items():
            if len(ending) == 3 and ending[1:] in tokens:
                sizes.add(2)
        return {k: tuple(sorted(v, reverse=True)) for k, v in found.items()}

    def symbols(self, token: str) -> list[str]:
        body = token.removesuffix(self.end)
        return [*body[:-1], body[-1] + self.end] if body != token else list(token)

    def merged(self, parts: list[str]) -> list[str]:
        """Tokens of a short row of symbols: always the pair of lowest rank first, the leftmost of equals."""
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
        return parts


    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Tokens that stand at the left (0) or right (1) end of ``token`` while it is merged, each with the rank that ends it."""
        known = self.edges.get((token, side))
        if known is None:
            known, ends = [], self.NEVER
            while token in self.parts:
                known.append((token, ends))
                ends, token = self.ranks[self.parts[token]], self.parts[token][side]
            known = [*known, (token, ends)][::-1]
            self.edges[known[-1][0], side] = known
        return known

    def apart(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of two tokens; of equal ranks the leftmost merge goes first.

        Parts of a token have lower ranks than the token, so the tokens at the border follow each other by rank.
        """
        ours, theirs, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            (a, a_ends), (b, b_ends) = ours[i], theirs[j]
            rank = self.ranks.get((a, b))
            if rank is not None and rank < a_ends and rank <= b_ends:
                return False
            if a_ends == b_ends == self.NEVER:
                return True
            i, j = (i + 1, j) if a_ends <= b_ends else (i, j + 1)


class Piece:
    """A growing piece of a word: for each prefix, what may follow its last token and how many tokens it has.

    Every prefix ends in the one token that stays apart from the last token of the prefix before it.
    """

    __slots__ = ("merges", "after", "count", "tail")

    def __init__(self, merges: Merges):
        self.merges, self.after, self.count, self.tail = merges, [merges.followers("")], [0], ""

    def copy(self) -> Piece:
        out = Piece(self.merges)
        out.after, out.count, out.tail = self.after[:], self.count[:], self.tail
        return out

    def _sized(self, sizes: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
        return sizes.get(self.tail[-3:]) or sizes.get(self.tail[-2:]) or ONE

    def add(self, letters: str) -> int:
        """Append a character's letters; the tokens of the piece if it ends here."""
        merges, after, count = self.merges, self.after, self.count
        for letter in letters:
            self.tail = tail = (self.tail + letter)[-merges.longest :]
            at = len(after)
            for size in self._sized(merges.open_sizes):
                if size <= at and (token := tail[-size:]) in merges.open and after[at - size][0][token]:
                    break
            after.append(merges.followers(token))
            count.append(count[at - size] + 1)
        for size in self._sized(merges.closed_sizes):
            if size <= at and (token := tail[-size:]) in merges.closed and after[at - size][1][token]:
                break
        return count[at - size] + 1


class _Steps(dict):
    def __init__(self, most: int, find):
        self.most, self.find = most, find

    def __missing__(self, text: str) -> bytes:
        found = self.find(text)
        if len(self) < self.most and len(text) <= REMEMBERED_LENGTH:
            self[text] = found
        return found


class PrefixCounter:
    """Steps of the token count along the code points of a text, for one vocabulary file."""

    def __init__(self, tokenizer: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(tokenizer)
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.letters, self.nodes = byte_letters(), {}
        self.specials = regex.compile("|".join(map(regex.escape, self.merges.specials)))
        self.pieces, self.words = _Steps(PIECES, self._piece), _Steps(WORDS, self._word)
        self.kind, self.normal = cache(self._kind), self.library.normalizer.normalize_str

    def spelled(self, char: str) -> str:
        return "".join([self.letters[b] for b in char.encode()])

    def _piece(self, piece: str) -> bytes:
        """Steps along one piece, a byte each."""
        if BLANKS.match(piece):
            return bytes(len(piece))
        merges, nodes = self.merges, self.nodes
        opened, closed, size_of, end_of = merges.open, merges.closed, merges.open_sizes.get, merges.closed_sizes.get
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        # For each prefix: what may follow its last token, its tokens if it goes on, and if it ends.
        path = [(merges.followers(""), 0, 0)]
        for at in range(1, len(spelled) + 1):
            node = nodes.get(spelled[:at]) if at <= REMEMBERED_LENGTH else None
            if node is None:
                three, two = spelled[at - 3 : at] if at > 2 else "", spelled[at - 2 : at] if at > 1 else ""
                for size in end_of(three) or end_of(two) or ONE:
                    if size <= at and (token := spelled[at - size : at]) in closed and path[at - size][0][1][token]:
                        break
                total = path[at - size][1] + 1
                for size in size_of(three) or size_of(two) or ONE:
                    if size <= at and (token := spelled[at - size : at]) in opened and path[at - size][0][0][token]:
                        break
                node = (merges.followers(token), path[at - size][1] + 1, total)
                if at <= REMEMBERED_LENGTH and len(nodes) < PREFIXES:
                    nodes[spelled[:at]] = node
            path.append(node)
        ends = np.cumsum([len(c.encode()) for c in piece]).tolist() if len(spelled) > len(piece) else range(1, len(piece) + 1)
        steps, told = array("b"), 0
        for end in ends:
            total = path[end][2]
            steps.append(total - told)
            told = total
        if piece in CONTRACTIONS and len(piece) == 3:
            # Before its last letter this is a mark and a letter.
            steps = array("b", [1, 1, told - 2])
        return steps.tobytes()

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PATTERN.findall(word)))

    def _kind(self, char: str) -> int:
        """Letter, number, mark or blank, as the library's own pattern has it."""
        parts = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str("a" + char + "!")]
        if len(parts) == 3:
            return NUMBER
        if parts[0] == "a" and parts[1] == "!":
            return BLANK
        return LETTER if parts[1] == "!" else MARK

    def _plain(self, text: str) -> np.ndarray:
        """Steps along a text without special strings."""
        if not UNUSUAL.search(text) and unicodedata.is_normalized("NFC", text):
            try:
                # A blank is a step of 0.
                return np.frombuffer(b"\0".join(map(self.words.__getitem__, text.replace("Σ", "σ").lower().split(" "))), np.int8)
            except OverflowError:
                pass
        return np.diff(np.array(_Walk(self).counts(text), np.int64), prepend=0)

    def steps(self, text: str) -> np.ndarray:
        """By how much each code point of ``text`` changes the number of tokens; their running sum counts every prefix.

        A special string is one token from its last character on; before that it is text.
        """
        parts, first = [], 0
        for found in self.specials.finditer(text):
            part = self._plain(text[first : found.end() - 1])
            before = int(part[: found.start() - first].sum())
            parts += [part, np.array([before + 1 - int(part.sum())])]
            first = found.end()
        rest = self._plain(text[first:])
        return np.concatenate([*parts, rest]) if parts else rest


class _Walk:
    """Counts along any text, character by character, by the library's own normal form and classes."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter
        self.done, self.held, self.piece, self.waiting = 0, 0, None, ""
        self.run, self.last = None, ""

    def state(self) -> tuple:
        return self.done, self.held, self.piece and self.piece.copy(), self.waiting, self.run, self.last

    def restore(self, state: tuple) -> None:
        self.done, self.held, self.piece, self.waiting, self.run, self.last = state

    def close(self) -> None:
        self.done += self.held
        self.held, self.piece, self.run, self.waiting = 0, None, None, ""

    def begin(self, char: str, run: int | None) -> None:
        self.close()
        self.piece, self.run = Piece(self.counter.merges), run
        self.held, self.last = self.piece.add(self.counter.spelled(char)), char

    def feed(self, char: str) -> None:
        kind = self.counter.kind(char)
        if kind == BLANK:
            self.close()
        elif self.waiting and self.waiting + char in CONTRACTIONS:
            # The mark was counted as a token of its own.
            word, self.done, self.held = self.waiting + char, self.done - 1, 0
            self.close()
            self.piece = Piece(self.counter.merges)
            for c in word:
                self.held = self.piece.add(self.counter.spelled(c))
        elif kind == LETTER and self.run == MARK and self.last == "'" and len(self.piece.count) == 2:
            word = self.last + char
            if word in CONTRACTIONS:
                self.held, self.run = self.piece.add(self.counter.spelled(char)), None
            else:
                self.begin(char, LETTER)
                self.waiting = word if any(c.startswith(word) for c in CONTRACTIONS) else ""
        elif kind != NUMBER and kind == self.run:
            self.held, self.waiting, self.last = self.piece.add(self.counter.spelled(char)), "", char
        else:
            self.begin(char, kind)

    def counts(self, text: str) -> list[int]:
        """Characters that the normal form may still join are taken back when the next one comes."""
        out, cluster, before = [], "", self.state()
        normal, kind = self.counter.normal, self.counter.kind
        for char in text:
            apart = not unicodedata.combining(char) and (kind(char) == BLANK or normal(cluster + char) == normal(cluster) + normal(char))
            if apart:
                cluster, before = char, self.state() if cluster else before
            else:
                cluster += char
                self.restore(before)
                before = self.state()
            for c in normal(cluster):
                self.feed(c)
            out.append(self.done + self.held)
        return out


@cache
def _counter(tokenizer: str) -> PrefixCounter:
    """One per worker process, so that later tasks find its words again."""
    return PrefixCounter(tokenizer)


def _tabled(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                steps = counter.steps(text)
                if steps.dtype != np.int8:
                    narrow = steps.astype(np.int8)
                    steps = narrow if np.array_equal(narrow, steps) else steps.astype(np.int32)
                total = int(steps.sum(dtype=np.int64))
                rows.append((doc_id, len(text.encode()), len(text), total, steps.itemsize, steps.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = zip(*rows) if rows else [()] * len(kinds)
            names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "width", "steps"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def prefix_table(documents: DataFrame, row_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, n_bytes, n_chars, n_tokens, width, steps)`` for each document.

    ``steps`` holds, in little-endian numbers of ``width`` bytes, by how much each code
    point changes the number of tokens, so the running sum at ``i`` is what the
    library counts for the first ``i`` code points alone. One row a document, made where the text is;
    a null text is an empty one. Repeated and null ids are rows like others, other
    columns are ignored, and an empty table gives no rows. Special strings are
    one token, as in the library's default; no token is added at the ends.
    """
    rows = documents.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_tabled(tokenizer), TABLE)


def _running(steps: bytes, width: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, "<i1" if width == 1 else "<i4"), dtype=np.int64)


def tokens_of_prefix(steps: Column, width: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points; all of them if there are fewer, 0 from 0 down, null for null."""

    @F.pandas_udf("long")
    def count(steps, width, chars):  # noqa: ANN001, ANN202
        import pandas as pd

        out = []
        for s, w, n in zip(steps, width, chars):
            n = None if pd.isna(n) else min(int(n), len(s) // w)
            out.append(None if n is None else int(_running(s, w)[n - 1]) if n > 0 else 0)
        return pd.Series(out, dtype="Int64")

    return count(steps, width, chars.cast("long"))


def longest_prefix(steps: Column, width: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens.

    Counts may fall again when a longer token forms, so the last prefix that
    fits is taken, not the first that does not. A negative budget fits nothing and gives null.
    """

    @F.pandas_udf("long")
    def cut(steps, width, budget):  # noqa: ANN001, ANN202
        import pandas as pd

        out = []
        for s, w, b in zip(steps, width, budget):
            if pd.isna(b) or b < 0:
                out.append(None)
                continue
            fits = np.flatnonzero(_running(s, w) <= b)
            out.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(out, dtype="Int64")

    return cut(steps, width, budget.cast("long"))


def truncated(documents: DataFrame, table: DataFrame, budget: int, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with ``text`` cut to ``budget`` tokens, without encoding anything again; needs distinct ids."""
    cuts = table.select(F.col("doc_id").alias("_id"), longest_prefix(F.col("steps"), F.col("width"), F.lit(budget)).alias("_cut"))
    joined = documents.join(cuts, F.col(row_id).eqNullSafe(F.col("_id")))
    return joined.withColumn(text, F.substr(text, F.lit(1), F.col("_cut").cast("int"))).select(*documents.columns)


def token_counts(documents: DataFrame, limit: int = 2_048, tokenizer: str = TOKENIZER) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each document, read from its stored prefix table.

    Rows are as in :func:`prefix_table`; a document is over the limit with more than ``limit`` tokens.
    """
    table, _ = keep(prefix_table(documents, tokenizer=tokenizer), "prefixes")
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
