"""Byte-pair vocabularies from tokenizer files, as the tables that the operators work on."""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex

#: Patterns fixed by the vocabularies: how text is cut before merges.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Letters and numbers that Unicode versions after 16 added. The vocabularies' library doesn't know them, so
#: for it they are neither.
LATER_LETTERS = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DF1"
    r"\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF3\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
    r"\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5"
    r"\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
LATER_NUMBERS = r"\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016FF4-\U00016FF6"
#: Characters of these texts at most are handled at a time; from a word that is longer, parts are handed on.
PIECE = 1 << 16
#: Characters at the end of what was read that may still change how it is cut: special strings, contractions.
BACK = 64
LATER = regex.compile(f"[{LATER_LETTERS}{LATER_NUMBERS}]")
#: Capitals of Unicode 16 and 17, which Python's own tables lack, with their small letters.
SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
SMALL |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}

_loaded: dict[str, "Vocabulary"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the files: itself where it prints, else the next from U+0100."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for b in range(256):
        if b in printing:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class Vocabulary:
    """Symbols of bytes, ranked merges, special strings and the cutting of texts into pieces."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token") or model.get("continuing_subword_prefix"):
            raise ValueError("only byte-level BPE vocabularies are supported")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.first = [vocab[x] for x in letters]
        self.last = [vocab[x + self.suffix] for x in letters]
        #: (left << 20 | right) -> rank, and the symbol that each rank makes
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        #: (left, right) symbols of each rank
        self.parts: list[tuple[int, int]] = []
        cut = len(self.suffix)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a] << 20 | vocab[b]] = rank
            self.parts.append((vocab[a], vocab[b]))
            self.made.append(vocab[a + b])
        back = {x: b for b, x in enumerate(letters)}
        #: the bytes of each id
        self.bytes: dict[int, bytes] = {}
        for token, at in vocab.items():
            plain = token[: -cut] if cut and token.endswith(self.suffix) else token
            self.bytes[at] = bytes(back[c] for c in plain)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for content, at in self.special.items():
            self.bytes[at] = content.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.prepare = self._normalizer(spec["normalizer"])
        self.normalizes = bool(spec["normalizer"])
        pattern = self._pattern(spec["pre_tokenizer"])
        self.pattern = regex.compile(pattern)
        self.pattern_of_latin = re.compile(_in_latin(pattern))
        self.pattern_of_later = regex.compile(_known(pattern), regex.V1)
        self.lookahead = sufficient_lookahead(self)
        #: bytes of a word that are worked on at a time
        self.window = 2 * self.lookahead + max(map(len, self.bytes.values())) + 64

    @staticmethod
    def _normalizer(spec: dict | None) -> Callable[[str], str]:
        steps = spec["normalizers"] if spec and spec["type"] == "Sequence" else [spec] if spec else []
        kinds = [x["type"] for x in steps]
        if kinds == []:
            return lambda text: text
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizers {kinds}")

        def prepare(text: str) -> str:
            if text.isascii():
                return text.lower()
            # letter by letter, so a final capital sigma becomes the common small one
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(SMALL).lower()

        return prepare

    @staticmethod
    def _pattern(spec: dict) -> str:
        if spec["type"] == "ByteLevel" and spec["use_regex"] and not spec["add_prefix_space"]:
            return BYTE_PATTERN
        first = spec["pretokenizers"][0] if spec["type"] == "Sequence" else {}
        if first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]:
            return first["pattern"]["Regex"]
        raise ValueError("unknown pre-tokenizer")

    def cutter(self, text: str) -> re.Pattern | regex.Pattern:
        """The pattern that cuts a text into words."""
        if _latin(text):
            return self.pattern_of_latin
        return self.pattern if not LATER.search(text) else self.pattern_of_later

    def symbols(self, word: bytes) -> list[int]:
        """The symbols of the single bytes of a whole word."""
        out = [self.first[b] for b in word]
        if out:
            out[-1] = self.last[word[-1]]
        return out

    def segments(self, chunks: Iterable[str]) -> Iterator[tuple[str, int | None]]:
        """(text, None) for pieces between special strings, the last of each run of pieces followed by (text, -1) or (text, id)."""
        rest = ""
        for chunk in chunks:
            rest += chunk
            while self.special_pattern is not None and (found := self.special_pattern.search(rest)):
                yield rest[: found.start()], self.special[found.group()]
                rest = rest[found.end() :]
            # what is left may end within a special string
            keep = 0
            for name in self.special:
                if name[0] in rest[-len(name) + 1 :]:
                    keep = max(keep, *(k for k in range(len(name)) if rest.endswith(name[:k])))
            if len(rest) > keep:
                yield rest[: len(rest) - keep], None
                rest = rest[len(rest) - keep :]
        yield rest, -1

    def words(self, chunks: Iterable[str]) -> Iterator[tuple[list[str], str, bool, int]]:
        """A text that comes in pieces, as (words, part, ended, special).

        Either whole words, or a part of one that is long, and whether it ends with it; then the id of the special string that follows, or -1.
        """
        raw = rest = ""
        inside: Callable | None = None
        for text, special in self.segments(chunks):
            final = special is not None
            raw += text
            cut = len(raw) if final else _boundary(raw) if self.normalizes else len(raw)
            rest += self.prepare(raw[:cut])
            raw = raw[cut:]
            if inside is not None:
                end = inside(rest).end()
                if end == len(rest) and not final:
                    if end > BACK:
                        yield [], rest[:-BACK], False, -1
                        rest = rest[-BACK:]
                    continue
                # before another word the last white space belongs to that
                end -= end < len(rest) and _white(rest[end - 1])
                yield [], rest[:end], True, -1
                rest, inside = rest[end:], None
            if final:
                yield self.cutter(rest).findall(rest), "", True, special
                rest = ""
                continue
            if len(rest) < PIECE:
                continue
            # a run of white space begins where no word goes on
            at = len(rest) - BACK
            while at > 0 and not (_white(rest[at]) and not _white(rest[at - 1])):
                at -= 1
            if at > 0:
                yield self.cutter(rest[:at]).findall(rest[:at]), "", True, -1
                rest = rest[at:]
                continue
            some, at = [], 0
            for found in self.cutter(rest).finditer(rest):
                if found.end() > len(rest) - BACK:
                    break
                some.append(found.group())
                at = found.end()
            yield some, "", True, -1
            rest = rest[at:]
            if len(rest) < PIECE:
                continue
            # white space that the vocabulary drops may come first
            found = self.cutter(rest).search(rest)
            rest = rest[found.start() :] if found else rest[-BACK:]
            if len(rest) >= PIECE:
                inside = self._going_on(rest[found.end() - found.start() - 1])
                yield [], rest[:-BACK], False, -1
                rest = rest[-BACK:]

    def _going_on(self, letter: str) -> Callable:
        """What matches as far as a text goes on with characters of the kind of ``letter``."""
        for kind in (r"\p{L}", r"\p{N}", r"\s", r"[^\s\p{L}\p{N}]"):
            pattern = regex.compile(f"(?:{_known(kind)})*", regex.V1)
            if pattern.match(letter).end():
                return pattern.match
        raise ValueError(letter)


def _known(pattern: str) -> str:
    """``pattern`` without the letters and numbers that the library doesn't know."""
    return pattern.replace(r"\p{L}", rf"[\p{{L}}--[{LATER_LETTERS}]]").replace(r"\p{N}", rf"[\p{{N}}--[{LATER_NUMBERS}]]")


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _in_latin(pattern: str) -> str:
    """``pattern`` for texts of characters up to U+00FF, with their classes written out."""
    chars = [chr(c) for c in range(256)]
    kinds = {k: "".join(re.escape(c) for c in chars if regex.match(k, c)) for k in (r"\p{L}", r"\p{N}", r"\s")}
    out, listed = [], False
    for part in re.findall(r"\\p\{.\}|\\.|.", pattern):
        listed = (listed or part == "[") and part != "]"
        if part == r"\S":
            out.append(f"[^{kinds[chr(92) + 's']}]")
        elif part in kinds:
            out.append(kinds[part] if listed else f"[{kinds[part]}]")
        else:
            out.append(part)
    return "".join(out)


def _white(letter: str) -> bool:
    """Whether a character is white space in the patterns."""
    return letter.isspace() and not "\x1c" <= letter <= "\x1f"


def sufficient_lookahead(vocab: Vocabulary) -> int:
    """Bytes before the end of what was read of a word within which tokens may still change.

    ``reach[x]``: the farthest that a difference can have moved left when it begins at a symbol x.
    """
    reach: dict[int, int] = {}
    for (a, b), ab in zip(vocab.parts, vocab.made):
        moved = reach.get(b, 0) + len(vocab.bytes[a])
        reach[ab] = max(reach.get(ab, 0), reach.get(a, 0), moved)
        reach[a] = max(reach.get(a, 0), moved)
    # the last symbol of a word may be another one than inside it
    return max(reach.values(), default=0) + (1 if vocab.suffix else 0)


class Window:
    """A word that comes in parts, of which no more is held than may still change, and a bounded part besides.

    ``settle(symbols, stable)`` gives what results from all merges of symbols of single bytes and how many bytes it stands for:
    tokens that end within the first ``stable`` bytes, or all where that is None.
    """

    def __init__(self, vocab: Vocabulary, settle: Callable[[list[int], int | None], tuple]):
        self.vocab, self.settle, self.held = vocab, settle, b""

    def feed(self, raw: bytes, ended: bool) -> Iterator:
        vocab, size = self.vocab, self.vocab.window
        for at in range(0, len(raw), size):
            self.held += raw[at : at + size]
            while len(self.held) > size:
                out, end = self.settle([vocab.first[b] for b in self.held], len(self.held) - vocab.lookahead)
                self.held = self.held[end:]
                yield out
        if ended:
            out, _ = self.settle(vocab.symbols(self.held), None)
            self.held = b""
            yield out


class Kept(dict):
    """What words result in, worked out when first asked for; words of up to 64 bytes are kept, within ``most`` bytes of memory."""

    def __init__(self, work: Callable, most: int = 1 << 26):
        super().__init__()
        self.work, self.most, self.used = work, most, 0

    def __missing__(self, word: str):
        raw = word.encode()
        out = self.work(raw)
        if len(raw) <= 64:
            # an entry takes the word, the result and about 200 bytes
            self.used += 200 + 5 * len(raw)
            if self.used > self.most:
                self.forget()
            self[word] = out
        return out

    def forget(self) -> None:
        """Also at the end of a task, since a worker may wait long for its next."""
        self.clear()
        self.used = 0


def _boundary(text: str) -> int:
    """The last place of a text before which normalisation doesn't depend on what follows."""
    at = len(text) - 1
    while at > 0 and (unicodedata.category(text[at])[0] == "M" or 0x1100 <= ord(text[at]) <= 0x11FF):
        at -= 1
    return max(at, 0)


def chunks_of(text: pa.StringScalar, size: int = PIECE) -> Iterator[str]:
    """A string of an Arrow column in pieces; null is empty."""
    raw = text.as_buffer()
    if raw is None or raw.size <= size:
        yield text.as_py() or ""
        return
    state, whole = codecs.getincrementaldecoder("utf-8")(), memoryview(raw)
    for at in range(0, raw.size, size):
        yield state.decode(whole[at : at + size], at + size >= raw.size)


def load(source: str) -> Vocabulary:
    """The vocabulary of a file's content, kept for later tasks of the same worker."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(source)
    return _loaded[key]
