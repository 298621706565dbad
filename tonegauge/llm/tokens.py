"""Token ids of texts by a public tokenizer, whose file is a parameter."""

import gc
import json
import os
import unicodedata

import numpy as np

#: Chunks a worker remembers before it starts anew; bounds its memory, changes no id.
CACHE = 300_000
#: A character for private use; the tokenizer keeps it apart from everything that white space parts.
MARK = "\ue0f7"
#: Marks that the tokenizer parts from letters before them.
TAIL = b".,;:!?"
#: Texts whose new chunks are encoded together.
GROUP = 128
#: The splitting pattern that makes chunks independent: letters, single digits, runs of other marks.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _letters(core: str) -> bool:
    """Letters only, also as the tokenizer sees them: some letters come apart into a letter and a mark."""
    form = unicodedata.normalize("NFC", core)
    return form.isalpha() and form.lower().isalpha()


class Known(dict):
    """Ids by chunk; a chunk asked for the first time is new and gets a buffer to be filled."""

    def __init__(self):
        super().__init__()
        self.new: dict[bytes, bytearray] = {}

    def __missing__(self, chunk: bytes) -> bytearray:
        held = self.new.get(chunk)
        if held is None:
            held = self.new[chunk] = bytearray()
        return held


def parts_at_space(tokenizer) -> bool:
    """Whether a tokenizer composes (NFC), lower-cases and drops white space, and then splits by WORDS."""
    spec = json.loads(tokenizer.to_str())
    normal, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = [(n["type"], n.get("content")) for n in normal.get("normalizers", ())]
    first = (split.get("pretokenizers") or [{}])[0]
    return (steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)] and first.get("type") == "Split"
            and first["pattern"] == {"Regex": WORDS} and first["behavior"] == "Removed" and first["invert"])


class Encoder:
    """Encodes white-space-separated chunks once each, if no token of its kind spans white space
    and letters part from the marks behind them; whole texts with any other tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parted = parts_at_space(self.tokenizer)
        self.known = Known()
        self.mark = self._encode([MARK])[0]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        #: Which ids end a word, if the tokenizer marks that.
        self.ends = np.array([n.endswith(suffix) for n in names]) if suffix else None

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, held: dict[bytes, bytearray]) -> None:
        """Tokens of new chunks. Letters and the marks after them never share a token, so chunks
        that differ in case or in such marks only are encoded once."""
        known, parts, letters, others = self.known, [], set(), set()
        for chunk in held:
            core, tail, kind = chunk.rstrip(TAIL), b"", letters
            if core.isalpha():  # of bytes: ASCII letters only
                tail, core = chunk[len(core):], core.lower()
            elif core and _letters(core.decode()):
                tail = chunk[len(core):]
            else:
                core, kind = chunk, others
            parts.append((core, tail))
            if core not in known:
                kind.add(core)
            if tail and tail not in known:
                others.add(tail)
        self._encode_words(list(letters))
        self._encode_new(list(others))
        for (chunk, buffer), (core, tail) in zip(held.items(), parts):
            ids = known[chunk] = known[core] + known[tail] if tail else known[core]
            buffer += ids

    def _encode_words(self, words: list[bytes]) -> None:
        """Words of letters as one text, cut where ids end a word; with marks if that can't be told."""
        if not words or self.ends is None:
            return self._encode_new(words)
        ids = self._encode([" ".join(map(bytes.decode, words))])[0]
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words):
            return self._encode_new(words)
        raw, ends = ids.tobytes(), ends.tolist()
        self.known.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))

    def _encode_new(self, chunks: list[bytes]) -> None:
        """Encodes chunks as one text with a mark between them, which is quicker than one by one.

        Chunks that hold the mark themselves are encoded alone.
        """
        odd = MARK.encode()
        plain = [c for c in chunks if odd not in c]
        if len(plain) < len(chunks):
            alone = [c for c in chunks if odd in c]
            self.known.update(zip(alone, (x.tobytes() for x in self._encode([c.decode() for c in alone]))))
        if not plain:
            return
        ids = self._encode([f" {MARK} ".join([*map(bytes.decode, plain), ""])])[0]
        size = len(self.mark)
        here = np.ones(len(ids) - size + 1, bool)
        for i, one in enumerate(self.mark):
            here &= ids[i:len(ids) - size + 1 + i] == one
        ends = np.flatnonzero(here)
        assert len(ends) == len(plain), "the mark is lost in the tokens"
        raw, starts = ids.tobytes(), [0, *(4 * (ends[:-1] + size)).tolist()]
        self.known.update(zip(plain, map(raw.__getitem__, map(slice, starts, (4 * ends).tolist()))))

    def ids(self, texts: list, end: int | None = 1) -> list[np.ndarray]:
        """Ids of whole UTF-8 texts as unsigned 32-bit integers, each then ``end``; a null text is empty."""
        last = b"" if end is None else int(end).to_bytes(4, "little")
        out = []
        if not self.parted:
            for at in range(0, len(texts), GROUP):
                found = self._encode([(t or b"").decode() for t in texts[at:at + GROUP]])
                out += [np.frombuffer(x.tobytes() + last, "<u4") for x in found]
            return out
        gc.disable()  # nothing here makes cycles, and a collection would walk all that is known
        try:
            for at in range(0, len(texts), GROUP):
                if len(self.known) > CACHE:
                    self.known.clear()
                # A new chunk's place is held by an empty buffer until the group's are encoded together.
                found = [[*map(self.known.__getitem__, (t or b"").split())] for t in texts[at:at + GROUP]]
                if self.known.new:
                    self._learn(self.known.new)
                    self.known.new = {}
                out += [np.frombuffer(b"".join(parts) + last, "<u4") for parts in found]
        finally:
            gc.enable()
        return out


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
