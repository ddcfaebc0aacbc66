"""What the operators should give, written without them."""

from __future__ import annotations


def words_of(text: str | None, lower: bool = False) -> list[str]:
    """The words of a text, without the library."""
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if lower and "A" <= c <= "Z" else c
    return [*out, word] if word else out


def near_groups(rows, size: int = 5, percent: int = 75) -> dict:
    """The smallest id reachable over links, and the size of the set, of each id."""
    sets: dict = {}
    for i, text in rows:
        words = words_of(text, lower=True)
        if len(words) >= size:
            own = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        else:
            own = {tuple(words)} if words else set()
        sets[i] = own
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}
