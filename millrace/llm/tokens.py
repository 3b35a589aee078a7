"""Token ids of whole texts through the tokenizers library, each word once.

Encoding a word costs far more than looking it up, and words repeat. Texts are
cut where the two supported kinds of tokenizer cut them before they merge: by
the pre-tokenizer's pattern in texts of simple characters, else at single
spaces. The ids of a piece come from the library, from its model alone where
the steps before it change nothing more, and are kept for the next occurrence.
So a text's ids are what the library gives for the whole text. A tokenizer of
another kind gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable
from types import ModuleType

# The pre-tokenizer patterns of the two kinds, for texts of ASCII
# and Latin-1 letters. Other texts never meet them.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
BYTE_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+"
WORD_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^\s{LETTER}0-9]+"
SIMPLE = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
# Names of special tokens that a search for their first two characters finds.
NAME = re.compile(r"[!-/:-@\[-`{-~]{2}")
# Pieces kept, some 350 bytes each.
KEPT_PIECES = 300_000


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text, a few MB; tasks get it by value."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def worker_kept(kind: str, definition: str | bytes, make: Callable[[], object], *options):
    """What ``make`` gives, kept by this Python worker from task to task.

    What a task learnt is so of use to the next one; a new worker starts anew.
    One thing of each kind is kept, so another tokenizer takes its place.
    """
    module = sys.modules.setdefault("millrace_worker", ModuleType("millrace_worker"))
    kept = module.__dict__.setdefault(kind, {})
    content = definition.encode() if isinstance(definition, str) else definition
    key = (len(content), zlib.crc32(content), *options)
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def worker_encoder(definition: str, kept_pieces: int = KEPT_PIECES, special_names: bool = True) -> Encoder:
    """The encoder of this Python worker."""
    make = lambda: Encoder(definition, kept_pieces, special_names)
    return worker_kept("encoders", definition, make, kept_pieces, special_names)


class Known(dict):
    """Ids of pieces, learnt when they are first asked for.

    Limited in number and forgotten all at once, which costs time only.
    """

    def __init__(self, learn: Callable[[str], bytes], most: int):
        super().__init__()
        self.learn, self.most = learn, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[piece] = self.learn(piece)
        return ids


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without adding special tokens.

    The name of a special token in a text is that token, as the library has it
    by default, or with ``special_names=False`` ordinary text. Texts that may
    hold such a name are given to the library whole.
    """

    def __init__(self, definition: str, kept_pieces: int = KEPT_PIECES, special_names: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not special_names
        self.model = self.tokenizer.model
        read = json.loads(definition)
        self.kind = _kind(read)
        # Signs that names begin with and that no step before the cuts can make or change.
        self.signs = sorted({t["content"][:2] for t in read.get("added_tokens") or []}) if special_names else []
        self.pattern = re.compile(BYTE_LEVEL if self.kind == "byte" else WORD_LEVEL)
        self.pieces = Known(self._merge, kept_pieces)
        self.words = Known(self._whole, kept_pieces // 4)
        # How the model spells the bytes of a character, as the library has it.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {ord(c): spell(c)[0][0] for c in map(chr, range(256)) if SIMPLE.fullmatch(c)}
        self.space = self.spelling[ord(" ")]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        return [self._encode(text) for text in texts]

    def _encode(self, text: str) -> bytes:
        if self.kind == "other" or any(sign in text for sign in self.signs):
            return self._whole(text)
        if SIMPLE.fullmatch(text):
            # The second kind puts texts in lower case before it cuts them.
            pieces = self.pattern.findall(text if self.kind == "byte" else text.lower())
            return b"".join(map(self.pieces.__getitem__, pieces))
        return b"".join(map(self.words.__getitem__, self._words(text)))

    def _whole(self, text: str) -> bytes:
        """Ids by all steps of the tokenizer."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merge(self, piece: str) -> bytes:
        """Ids by the tokenizer's model alone, for pieces its other steps leave whole."""
        plain = piece.isascii() and piece.isprintable()
        spelt = piece.replace(" ", self.space) if plain else piece.translate(self.spelling)
        return array("I", [token.id for token in self.model.tokenize(spelt)]).tobytes()

    def _words(self, text: str) -> list[str]:
        """Words of any text, each with all that the cuts at spaces leave to it."""
        if self.kind == "word":
            return text.split(" ")
        # Next to other white space a space may belong to it: no cut there.
        first, *rest = re.split(r"(?<=\S) (?=\S)", text)
        return [first, *[" " + word for word in rest]]


def _kind(definition: dict) -> str:
    """``byte``, ``word`` or ``other``: which rule for cutting texts holds."""
    if definition.get("truncation") or definition.get("padding"):
        return "other"
    if any(not t["special"] or not NAME.match(t["content"]) for t in definition.get("added_tokens") or []):
        return "other"
    before = definition.get("pre_tokenizer") or {}
    names = [n.get("type") for n in (definition.get("normalizer") or {}).get("normalizers", [])]
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
        return "other" if definition.get("normalizer") else "byte"
    steps = before.get("pretokenizers") or [{}]
    pattern = steps[0].get("pattern", {}).get("Regex")
    same = pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    if same and names == ["NFC", "Replace", "Lowercase"] and definition["model"].get("end_of_word_suffix") == "</w>":
        return "word"
    return "other"
