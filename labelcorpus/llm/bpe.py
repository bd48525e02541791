"""Byte-level BPE encoding and decoding by lazily determinised transducers.

Encoding. A token sequence is the BPE encoding of its bytes exactly if every two neighbours are: merging the bytes of
the pair gives the pair back. So the merges compile into a transducer over bytes that guesses token borders and checks
neighbours. It is determinised while it runs: a state is the set of all nodes of the tokens' byte tree in which an open
guess may be, and each state and step is built when it is first met. Beside the state runs a register with the token
that ends at each border: of the tokens that end at a byte exactly one is a neighbour of the token that ends where it
begins, since bytes have one encoding. (With the register inside the states nearly every new word makes new ones.) What
all open guesses have in common is written, so the output lags the input by some lengths of the longest token.
Checked pairs and the ids of short words are kept in tables that are emptied when they are full. The short words that a
batch of texts brings anew run through the machine together, one byte of each at a time, in numpy arrays; long words
run alone.

Decoding. The state of a UTF-8 decoder is the unfinished character so far (at most three bytes). Its steps over whole
tokens are built when first met from its steps over bytes; ill-formed bytes become U+FFFD (one for each maximal part of
a character), and ids outside the vocabulary are an error.

Both work row by row, without a shuffle. A text is read as a stream of words; what a task holds is one text with its ids.

Defined cases: null text has no ids (an empty sequence), as has empty text; null ids decode to an empty text. Texts of
any length are read to their end. Repeated rows are encoded one by one; extra columns are ignored unless carried; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gc
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_STATES = 20_000
MOST_PAIRS = 300_000
MOST_WORDS = 200_000
#: Words up to this length (in bytes) run together, so many of them at once, where at most so many tokens end at a byte.
LONGEST_TOGETHER = 64
TOGETHER = 20_000
MOST_ENDS = 8
#: Slots of the pair table of words that run together.
PAIR_SLOTS = 1 << 20
#: Characters of text whose words are gathered.
GATHERED = 1 << 21
#: Within a longer word what is sure is written after every so many bytes.
WRITE_EVERY = 1_024
#: Ids and texts go back to Spark in batches of about this many bytes.
BATCH_BYTES = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """The vocabulary with the questions that the transducer asks of it.

    A token's *spine* on one side is what lies at that end while its bytes are being merged: the token itself, the part
    at that end of its last merge, that part's part and so on, each with the rank of the merge that ends it.
    """
    NEVER = 1 << 60

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        # The tokens' bytes as a tree: (node, byte) -> node, and the nodes' tokens and whether they go on.
        self.child: dict[int, int] = {}
        self.ends: list[int | None] = [None]
        self.goes_on = [True]
        for token, i in ranks.items():
            node = 0
            for byte in token:
                self.goes_on[node] = True
                found = self.child.get(node << 8 | byte)
                if found is None:
                    found = self.child[node << 8 | byte] = len(self.ends)
                    self.ends.append(None)
                    self.goes_on.append(False)
                node = found
            self.ends[node] = i
        self._left: dict[int, tuple] = {}
        self._right: dict[int, tuple] = {}
        self._neighbours: dict[int, bool] = {}

    def merges(self, data: bytes) -> tuple[list[bytes], list[bytes]]:
        """The parts that are left after merging the lowest-ranked (then leftmost) pair for ever, and those before the last merge."""
        parts = before = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(parts) > 1:
            low, at = self.NEVER, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1], self.NEVER)
                if r < low:
                    low, at = r, i
            if at < 0:
                break
            before, parts = parts, [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]
        return parts, before

    def _learn(self, token: int) -> None:
        data = self.token[token]
        parts, before = self.merges(data)
        if len(parts) != 1:  # merging never makes this token: no text has it but as a whole word
            self._left[token] = self._right[token] = ()
            return
        left = right = ((data, self.NEVER),)
        if len(before) == 2:
            if max(self.ranks[p] for p in before) >= token:
                raise ValueError("a token has to rank after its parts")
            left += ((before[0], token),) + self.spine(self._left, self.ranks[before[0]])[1:]
            right += ((before[1], token),) + self.spine(self._right, self.ranks[before[1]])[1:]
        self._left[token], self._right[token] = left, right

    def spine(self, side: dict[int, tuple], token: int) -> tuple:
        found = side.get(token)
        if found is None:
            self._learn(token)
            found = side[token]
        return found

    def neighbours(self, left: int, right: int) -> bool:
        """True if merging leaves the border between the two tokens (-1: no token on the left).

        A merge across the border takes place if its rank comes before those that end its two parts; of equal ranks the
        leftmost goes first.
        """
        pair = left << 32 | right
        known = self._neighbours.get(pair)
        if known is None:
            if len(self._neighbours) >= MOST_PAIRS:
                self._neighbours.clear()
            known = self._neighbours[pair] = self._border(left, right)
        return known

    def _border(self, left: int, right: int) -> bool:
        heads = self.spine(self._left, right)
        if not heads:
            return False
        if left < 0:
            return True
        rank = self.ranks.get
        for tail, tail_ends in self.spine(self._right, left):
            for head, head_ends in heads:
                r = rank(tail + head)
                if r is not None and r < tail_ends and r <= head_ends:
                    return False
        return True


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(ids, "<u4").tobytes()


class Words(dict):
    """word -> packed ids; a word that was not learned is encoded alone and, if it is long, not kept."""
    __slots__ = ("encoder",)

    def __missing__(self, word: str) -> bytes:
        data = word.encode()
        ids = pack(self.encoder.word(data))
        if len(data) <= LONGEST_TOGETHER:
            if len(self) > 2 * MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Text to ids. ``steps`` leads from (state, byte) to the next state; ``opens`` holds a state's nodes by the bytes read
    since their border, the most first, ``ends`` the tokens that end there: (length, id) of all but the shortest, the longest
    first, and the shortest, which needs no check where the others fail."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.merges = Merges(ranks)
        self.pattern = regex.compile(pattern)
        self.known = Words()
        self.known.encoder = self
        self.token_length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.token_length[i] = len(token)
        self.pairs = np.full(PAIR_SLOTS, -1, np.int64)
        self.fit = np.zeros(PAIR_SLOTS, bool)
        self.restart()

    def restart(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, int] = {}
        self.opens: list[tuple] = []
        self.ends: list[tuple] = []
        # The same for words that run together: steps, and the tokens that end at a state (length, id, number of the longer).
        self.table = np.full((256, 256), -1, np.int32)
        self.end_length = np.zeros((256, MOST_ENDS), np.int32)
        self.end_token = np.zeros((256, MOST_ENDS), np.int32)
        self.shortest = np.zeros(256, np.int32)
        self.longer = np.zeros(256, np.int32)
        self.state(((0, 0),), ((), -1))

    def state(self, opens: tuple, ends: tuple) -> int:
        number = self.numbers.get((opens, ends))
        if number is None:
            number = self.numbers[opens, ends] = len(self.opens)
            self.opens.append(opens)
            self.ends.append(ends)
            if number == len(self.table):
                for name, empty in (("table", -1), ("end_length", 0), ("end_token", 0), ("shortest", 0), ("longer", 0)):
                    old = getattr(self, name)
                    setattr(self, name, np.concatenate([old, np.full_like(old, empty)]))
            longer, self.shortest[number] = ends
            self.longer[number] = len(longer)
            for k, (length, token) in enumerate(longer[:MOST_ENDS]):
                self.end_length[number, k], self.end_token[number, k] = length, token
        return number

    def step(self, number: int, byte: int) -> int:
        """Builds a step: every open guess reads the byte, and a new guess begins behind it."""
        merges = self.merges
        opens, ends = [], []
        for length, node in self.opens[number]:
            node = merges.child.get(node << 8 | byte)
            if node is not None:
                if merges.goes_on[node]:
                    opens.append((length + 1, node))
                if merges.ends[node] is not None and merges.spine(merges._left, merges.ends[node]):
                    ends.append((length + 1, merges.ends[node]))
        to = self.steps[number << 8 | byte] = self.state((*opens, (0, 0)), (tuple(ends[:-1]), ends[-1][1]))
        self.table[number, byte] = to
        return to

    def word(self, data: bytes) -> list[int]:
        """Ids of one word. A word that is a token by itself is that token, merges or not."""
        token = self.merges.ranks.get(data)
        if token is not None:
            return [token]
        if len(self.opens) > MOST_STATES:
            self.restart()
        steps, ends, neighbours = self.steps, self.ends, self.merges.neighbours
        known = self.merges._neighbours
        written: list[int] = []
        register = [-1]  # the token that ends at each border since the last one written
        state, at = 0, 0
        for byte in data:
            key = state << 8 | byte
            state = steps.get(key)
            if state is None:
                state = self.step(key >> 8, byte)
            at += 1
            longer, token = ends[state]
            for length, other in longer:
                left = register[at - length]
                fits = known.get(left << 32 | other)
                if fits or fits is None and neighbours(left, other):
                    token = other
                    break
            register.append(token)
            if at >= WRITE_EVERY:
                at = self.write(state, register, written)
        return written + self.path(register, at)

    def path(self, register: list[int], border: int) -> list[int]:
        """The tokens from the register's beginning to a border."""
        out, tokens = [], self.merges.token
        while border:
            out.append(register[border])
            border -= len(tokens[register[border]])
        out.reverse()
        return out

    def write(self, state: int, register: list[int], written: list[int]) -> int:
        """Writes the tokens that the paths to all open borders share, and drops their part of the register."""
        end, tokens = len(register) - 1, self.merges.token
        borders = {end - length for length, _ in self.opens[state]}
        while len(borders) > 1:
            last = max(borders)
            borders.remove(last)
            borders.add(last - len(tokens[register[last]]))
        shared = borders.pop()
        written += self.path(register, shared)
        if shared:
            register[:] = [register[shared], *register[shared + 1:]]
        return end - shared

    def fits(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``neighbours`` for arrays, by a table in which a pair may push out another one."""
        pair = (left.astype(np.int64) + 1) << 32 | token
        slot = (pair * 0x9E3779B97F4A7C1 >> 24) & (PAIR_SLOTS - 1)
        fit = self.fit[slot]
        missing = np.flatnonzero(self.pairs[slot] != pair)
        if len(missing):
            new, back = np.unique(pair[missing], return_inverse=True)
            answers = np.array([self.merges._border((p >> 32) - 1, p & 0xFFFFFFFF) for p in new.tolist()], bool)
            fit[missing] = answers[back]
            self.pairs[slot[missing]], self.fit[slot[missing]] = pair[missing], fit[missing]
        return fit

    def together(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of at most LONGEST_TOGETHER bytes: ``word`` for all of them at once."""
        if len(self.opens) > MOST_STATES:
            self.restart()
        lengths = np.array([len(w) for w in words])
        order = np.argsort(-lengths, kind="stable")
        lengths, most = lengths[order], int(lengths[order[0]])
        given = np.array([words[k] for k in order.tolist()], dtype=f"S{most}").view(np.uint8).reshape(len(words), most).T
        given = np.ascontiguousarray(given)
        register = np.full((most + 1, len(words)), -1, np.int32)
        state, alone = np.zeros(len(words), np.int32), np.zeros(len(words), bool)
        for at in range(1, most + 1):
            n = int(np.searchsorted(-lengths, -at, side="right"))
            before, byte = state[:n], given[at - 1, :n]
            to = self.table[before, byte]
            missing = np.flatnonzero(to < 0)
            if len(missing):
                for key in np.unique(before[missing].astype(np.int64) << 8 | byte[missing]).tolist():
                    self.step(key >> 8, key & 255)
                to = self.table[before, byte]
            state[:n] = to
            token, longer = self.shortest[to], self.longer[to]
            alone[:n] |= longer > MOST_ENDS
            unsure = np.flatnonzero((longer > 0) & ~alone[:n])
            for k in range(MOST_ENDS):
                if not len(unsure):
                    break
                of = to[unsure]
                other = self.end_token[of, k]
                fit = self.fits(register[at - self.end_length[of, k], unsure], other)
                token[unsure[fit]] = other[fit]
                unsure = unsure[~fit]
                unsure = unsure[longer[unsure] > k + 1]
            register[at, :n] = token
        # Back from the ends.
        border, who, ids = lengths.copy(), np.arange(len(words)), []
        border[alone] = 0
        while len(who):
            who = who[border[who] > 0]
            token = register[border[who], who]
            ids.append((who, token))
            border[who] -= self.token_length[token]
        who, token = (np.concatenate(c)[::-1] for c in zip(*ids))
        by_word = np.argsort(who, kind="stable")
        flat = token[by_word].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(who[by_word], np.arange(len(words) + 1))).tolist()
        out: list = [None] * len(words)
        for k, place in enumerate(order.tolist()):
            out[place] = pack(self.word(words[place])) if alone[k] else flat[cuts[k]:cuts[k + 1]]
        return out

    def learn(self, words: set[str]) -> None:
        """Has the table of words know these."""
        if len(self.known) + len(words) > MOST_WORDS:
            self.known.clear()
        new = [(w, w.encode()) for w in words.difference(self.known) if len(w) <= LONGEST_TOGETHER]
        ranks = self.merges.ranks
        self.known.update((w, pack([ranks[data]])) for w, data in new if data in ranks)
        # A null byte at a word's end would get lost in an array of byte strings.
        new = [(w, data) for w, data in new if data not in ranks and len(data) <= LONGEST_TOGETHER and data[-1]]
        for at in range(0, len(new), TOGETHER):
            part = new[at:at + TOGETHER]
            self.known.update(zip((w for w, _ in part), self.together([data for _, data in part])))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, packed; the words of some texts are learned together."""
        ids = self.known.__getitem__

        def done() -> Iterator[bytes]:
            self.learn(set(chain.from_iterable(held)))
            for words in held:
                yield b"".join(map(ids, words))
        held, size = [], 0
        for text in texts:
            if len(text) > GATHERED:  # read as a stream
                yield from done()
                held, size = [], 0
                yield b"".join(ids(m.group()) for m in self.pattern.finditer(text))
                continue
            held.append(self.pattern.findall(text))
            size += len(text)
            if size > GATHERED:
                yield from done()
                held, size = [], 0
        yield from done()

    def __call__(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode([text])), "<u4").tolist()


def utf8_step(tail: bytes, byte: int) -> tuple[bytes, str]:
    """The UTF-8 machine: unfinished bytes and the next one to unfinished bytes and text."""
    if tail:
        lead = tail[0]
        low, high = 0x80, 0xBF
        if len(tail) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
        if not low <= byte <= high:
            rest, text = utf8_step(b"", byte)
            return rest, "�" + text
        tail += bytes((byte,))
        if len(tail) < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
            return tail, ""
        return b"", tail.decode()
    if byte < 0x80:
        return b"", chr(byte)
    if 0xC2 <= byte <= 0xF4:
        return bytes((byte,)), ""
    return b"", "�"


class DecoderState(dict):
    """Token -> (next state, text), filled when a token is first read after these unfinished bytes."""
    __slots__ = ("machine", "tail")

    def __init__(self, machine: "Decoder", tail: bytes):
        super().__init__()
        self.machine, self.tail = machine, tail

    def __missing__(self, token: int) -> tuple["DecoderState", str]:
        tail, text = self.tail, []
        for byte in self.machine.tokens[token]:
            tail, more = utf8_step(tail, byte)
            text.append(more)
        step = self[token] = self.machine.state(tail), "".join(text)
        return step


class Decoder:
    """Ids to text, in any number of parts: a character that tokens share is held back until it is whole."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: t for t, i in ranks.items()}
        self.states: dict[bytes, DecoderState] = {}
        self.start = self.at = self.state(b"")
        #: The tokens that are whole characters.
        self.plain = {}
        for token in self.tokens:
            state, text = self.start[token]
            if state is self.start:
                self.plain[token] = text

    def state(self, tail: bytes) -> DecoderState:
        found = self.states.get(tail)
        if found is None:
            if len(self.states) > MOST_STATES:
                self.states = {b"": self.start}
            found = self.states[tail] = DecoderState(self, tail)
        return found

    def feed(self, ids: Sequence[int]) -> str:
        if self.at is self.start:
            try:
                return "".join(map(self.plain.__getitem__, ids))
            except KeyError:  # some character is spread over tokens
                pass
        state, out = self.at, []
        for token in ids:
            state, text = state[token]
            out.append(text)
        self.at = state
        return "".join(out)

    def finish(self) -> str:
        """Ends the text: an unfinished character becomes U+FFFD."""
        unfinished, self.at = self.at.tail, self.start
        return "�" if unfinished else ""


def _sized(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (last value: bytes or text) as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[-1])
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
           ids: str = "ids") -> DataFrame:
    """key and ids for every row: unsigned 32-bit little-endian ids in one binary value (see ``id_array``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(ranks_path), pattern)

        def rows() -> Iterator[tuple]:
            keys = deque()  # of the texts whose words are being gathered

            def texts() -> Iterator[str]:
                for batch in batches:
                    for k, t in zip(batch["k"], batch["t"]):
                        keys.append(k.as_py())
                        yield t.as_py() or ""
            for out in encoder.encode(texts()):
                yield keys.popleft(), out
        collecting = gc.isenabled()
        gc.disable()  # the machine's many small objects hold no circles, walking them would double the time
        try:
            yield from _sized(rows(), pa.schema([("k", kind), ("ids", pa.binary())]))
        finally:
            if collecting:
                gc.enable()
    field = docs.schema[key].dataType
    kind = _arrow_type(field)
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        run, f"k {field.simpleString()}, ids binary")
    return out.select(F.col("k").alias(key), F.col("ids").alias(ids))


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids", text: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """key, the ``carry`` columns and the text of the ids (binary as of ``encode``, or an array) of every row."""
    packed = encoded.schema[ids].dataType.simpleString() == "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks_path))
        for batch in batches:
            texts = []
            for value in batch["i"]:
                given = value.as_py()
                if packed:
                    given = memoryview(given or b"").cast("I")
                texts.append(decoder.feed(given or ()) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch["c"], pa.array(texts, pa.string())], names=["c", "t"])
    kept = encoded.select(F.struct(key, *carry).alias("c"), F.col(ids).alias("i"))
    out = kept.mapInArrow(run, f"c {kept.schema['c'].dataType.simpleString()}, t string")
    return out.select(*[F.col("c")[c].alias(c) for c in (key, *carry)], F.col("t").alias(text))


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def id_array(packed):
    """Packed ids as an array of integers, inside Spark."""
    digits = F.hex(packed)
    at = F.sequence(F.lit(0), F.length(packed).cast("int") - 4, F.lit(4))
    value = F.transform(at, lambda i: F.conv(F.concat(*[F.substr(digits, 2 * (i + n) + 1, F.lit(2)) for n in (3, 2, 1, 0)]), 16, 10).cast("bigint"))
    return F.when(F.length(packed) == 0, F.array().cast("array<bigint>")).otherwise(value)
