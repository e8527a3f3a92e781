"""Byte-pair encodings as paths: which token may follow which.

A split of a text into tokens is the encoder's own split exactly if every two neighbours are: the
encoder, given the text of the two alone, returns these two. So each prefix of a text has one last
token, found among the tokens that end there.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

MEMO_LIMIT = 1_000_000


class Pairs:
    """Remembers, up to a limit, which pairs of tokens the encoder leaves as they are.

    ``rank(a, b)`` is the place of the merge of two neighbours in the merge order, or None;
    ``spell(token)`` gives the symbols a token is made of. Tokens and symbols are strings.
    """

    def __init__(
        self,
        rank: Callable[[str, str], Hashable | None],
        spell: Callable[[str], Sequence[str]],
    ):
        self.rank, self.spell = rank, spell
        self.known: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, list | None] = {}

    def history(self, token: str) -> list[tuple[Hashable, str, str]] | None:
        """(rank, first part, last part) after each merge on the way from symbols to ``token``;
        None if the encoder makes something else of the token's text. The first entry is the
        state before any merge.
        """
        if token not in self.histories:
            parts = list(self.spell(token))
            steps = [(None, parts[0], parts[-1])]
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    rank = self.rank(parts[i], parts[i + 1])
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.histories[token] = steps if parts == [token] else None
        return self.histories[token]

    def fit(self, *tokens: str) -> bool:
        """Whether the encoder splits the text of one or two tokens into just these."""
        if len(tokens) == 1:
            return self.history(tokens[0]) is not None
        fits = self.known.get(tokens)
        if fits is None:
            if len(self.known) >= MEMO_LIMIT:
                self.known.clear()
            fits = self.known[tokens] = self._apart(*map(self.history, tokens))
        return fits

    def _apart(self, a, b) -> bool:
        """Whether no merge across the border comes before the merges on its two sides.

        Each side goes its own way until a merge across the border is the best there is. Of equal
        ranks the leftmost goes first, so the left side before the border, the border before the
        right side.
        """
        if a is None or b is None:
            return False
        i, j = 1, 1
        while True:
            left = a[i][0] if i < len(a) else None
            right = b[j][0] if j < len(b) else None
            border = self.rank(a[i - 1][2], b[j - 1][1])
            if border is not None:
                if (left is None or border < left) and (right is None or border <= right):
                    return False
            elif left is None and right is None:
                return True
            if right is None or (left is not None and left <= right):
                i += 1
            else:
                j += 1
