"""Plain statements of the rules, for small inputs."""

from __future__ import annotations


def pair_places(rows):
    """Adjacent pairs of (ord, side, tokens) rows with their places, in order."""
    for place, side, tokens in sorted(rows):
        for pos in range(len(tokens) - 1):
            yield (tokens[pos], tokens[pos + 1]), (place, side, pos)


def pair_table(rows):
    table = {}
    for pair, place in pair_places(rows):
        n, first = table.get(pair, (0, place))
        table[pair] = (n + 1, min(first, place))
    return table


def leading_pair(rows):
    table = pair_table(rows)
    return min(table, key=lambda p: (-table[p][0], table[p][1])) if table else None


def merge(tokens, pair, token):
    out, rest = [], list(tokens)
    while rest:
        if tuple(rest[:2]) == pair:
            out.append(token)
            rest = rest[2:]
        else:
            out.append(rest.pop(0))
    return out


def train(texts, rounds):
    """Merges of {(ord, side): text}, one pair per round, and the final rows."""
    rows = [(o, s, list(t.encode())) for (o, s), t in texts.items()]
    merges = []
    for token in range(256, 256 + rounds):
        pair = leading_pair(rows)
        if pair is None:
            break
        merges.append((*pair, token))
        rows = [(o, s, merge(t, pair, token)) for o, s, t in rows]
    return merges, {(o, s): t for o, s, t in rows}


def encode(text, merges):
    """Merge the lowest known id in the row until none is left."""
    ids = {(left, right): token for left, right, token in merges}
    tokens = list(text.encode())
    while True:
        known = [ids[p] for p in zip(tokens, tokens[1:]) if p in ids]
        if not known:
            return tokens
        token = min(known)
        tokens = merge(tokens, next(p for p, t in ids.items() if t == token), token)
