"""Byte-level BPE encoding of whole texts.

The public vocabulary comes as a JSON file and as a file of ranks; both give the same
ids (the tests compare them), and the ranks encode several times as fast. A text that holds
the string of an added token, or runs too long for the rank encoder's pattern matcher, goes
to the JSON's encoder.
"""

from __future__ import annotations

import base64
import json

import numpy as np


class Encoder:
    """Ids, and character spans, of texts."""

    def __init__(self, ranks_path: str, json_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        with open(json_path, encoding="utf-8") as file:
            self.added = [token["content"] for token in json.load(file).get("added_tokens", [])]
        self.json_path, self.json = json_path, None

    def _whole(self, text: str):
        if self.json is None:
            from tokenizers import Tokenizer

            self.json = Tokenizer.from_file(self.json_path)
        return self.json.encode(text, add_special_tokens=False)

    def holds_added(self, text: str) -> bool:
        """Whether the string of an added token, such as an end-of-text mark, stands in the text."""
        return any(token in text for token in self.added)

    def ids(self, text: str) -> np.ndarray:
        if self.holds_added(text):
            return np.array(self._whole(text).ids, np.uint32)
        try:
            found = self.ranks.encode_ordinary(text)
        except (ValueError, RuntimeError):
            found = self._whole(text).ids
        return np.array(found, np.uint32)

    def token_spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end (code points) of every token; a token of part of a character spans the character."""
        if self.holds_added(text):
            spans = np.array(self._whole(text).offsets, np.int64).reshape(-1, 2)
            return spans[:, 0], spans[:, 1]
        ends = np.cumsum(self.sizes[self.ids(text)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character of each byte
        return char[starts], char[ends - 1] + 1
