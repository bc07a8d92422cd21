"""Maximal runs (periodic stretches) of word sequences, found on a Re-Pair grammar of each text.

Re-Pair replaces the pair of symbols that occurs most often by a new symbol until no pair occurs twice. Here the texts of a
batch go through it together, no symbol being shared by two texts, and a round replaces all pairs that occur more often than
those they overlap: these replacements do not touch each other, so one round stands for many steps in order of frequency.

A run lies across the boundary of a rule, or across one between symbols that no rule takes in. So runs are looked for around
each boundary once, within what the rule stands for, and are carried to every place the rule is derived at. Around a boundary
a run of three periods or more shows a square (two equal stretches of the period's length) that ends, starts or has its middle
there, hence two equal grams at the distance of the period. Grams of 8, 16, 32... words name the candidates for periods from
their length to its double; comparing words decides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

# Fixed by the contract: a run has at least so many words and periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# Words of the shortest gram: every run shows two of it one period apart, as 24 words hold 8 and twice any period below 8.
GRAM = 8
# Candidates that are compared at a time.
CANDIDATES = 1 << 20
# Words that are compared before places in one long stretch are told apart.
SHORT = 16


@dataclass
class Grammar:
    """Rules in order of their making, each at one of its places: symbols from ``first`` on are rules.

    ``at`` and ``symbols`` are what is left of the texts: the places and symbols that no rule takes in.
    """

    first: int
    left: list[np.ndarray] = field(default_factory=list)
    right: list[np.ndarray] = field(default_factory=list)
    begin: list[np.ndarray] = field(default_factory=list)
    middle: list[np.ndarray] = field(default_factory=list)
    end: list[np.ndarray] = field(default_factory=list)
    at: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    symbols: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    repeated: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    def rules(self) -> list[np.ndarray]:
        """(left, right, begin, middle, end) of all rules."""
        none = [np.empty(0, np.int64)]
        return [np.concatenate(none + x) for x in (self.left, self.right, self.begin, self.middle, self.end)]


def re_pair(words: np.ndarray, ends: np.ndarray) -> Grammar:
    """The grammar of texts that lie end to end: ``words`` are numbers that no two texts share, ``ends`` the texts' ends."""
    symbols, begin = words.astype(np.int64), np.arange(len(words))
    end = begin + 1
    following = int(symbols.max()) + 1 if len(symbols) else 0
    grammar, done = Grammar(following), []
    live = np.ones(len(words), bool)  # whether the pair that starts here may still be replaced
    live[ends[ends > 0] - 1] = False
    while len(symbols):
        pair = np.flatnonzero(live)
        key = symbols[pair] * following + symbols[pair + 1]
        # In a stretch of one symbol every second pair counts, as pairs must not overlap.
        same = np.zeros(len(symbols), bool)
        same[pair] = symbols[pair] == symbols[pair + 1]
        here = np.arange(len(symbols))
        stretch = np.maximum.accumulate(np.where(np.r_[True, ~same[:-1]], here, 0))
        odd = same[pair] & ((here - stretch)[pair] % 2 == 1)
        kinds, kind, times = np.unique(key, return_inverse=True, return_counts=True)
        often = np.bincount(kind[~odd], minlength=len(kinds)) if len(kinds) else times
        alive = often[kind] > 1
        live[pair[~alive]] = False
        if not len(grammar.repeated):
            grammar.repeated = live.copy()
        # A total order of the kinds: frequency, then a number that looks random, so that chains of neighbours stay short.
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((kinds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), often))] = np.arange(1, len(kinds) + 1)
        priority = np.zeros(len(symbols) + 1, np.int64)
        priority[pair] = np.where(alive & ~odd, rank[kind], 0)
        chosen = np.flatnonzero((priority[:-1] > 0) & (priority[:-1] > np.r_[0, priority[:-2]]) & (priority[:-1] > priority[1:]))
        if len(chosen):
            which = kind[np.searchsorted(pair, chosen)]
            _, place, number = np.unique(which, return_index=True, return_inverse=True)
            place = chosen[place]
            for column, values in ((grammar.left, symbols[place]), (grammar.right, symbols[place + 1]), (grammar.begin, begin[place]), (grammar.middle, begin[place + 1]), (grammar.end, end[place + 1])):
                column.append(values)
            symbols[chosen] = following + number
            end[chosen] = end[chosen + 1]
            live[chosen] = live[chosen + 1]
            following += len(place)
        stays = np.ones(len(symbols), bool)
        stays[chosen + 1] = False
        symbols, begin, end, live = symbols[stays], begin[stays], end[stays], live[stays]
        idle = ~live & ~np.r_[False, live[:-1]]
        done.append((begin[idle], symbols[idle]))
        symbols, begin, end, live = symbols[~idle], begin[~idle], end[~idle], live[~idle]
    if done:
        at, left_over = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
        order = np.argsort(at)
        grammar.at, grammar.symbols = at[order], left_over[order]
    return grammar


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _equal_words(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """For each pair of places how many words on from them (``step`` 1) or back (-1) are equal, at most ``room``."""
    equal, active, width = np.zeros(len(a), np.int64), np.flatnonzero(room > 0), 16
    while len(active):
        offsets = np.arange(width)
        x = a[active, None] + step * (equal[active, None] + offsets)
        y = b[active, None] + step * (equal[active, None] + offsets)
        inside = equal[active, None] + offsets < room[active, None]
        last = len(words) - 1
        match = inside & (words[np.clip(x, 0, last)] == words[np.clip(y, 0, last)])
        whole = match.all(axis=1)
        equal[active] += np.where(whole, width, match.argmin(axis=1))
        active = active[whole]
        width = max(16, min(4096, 4 * width, (1 << 22) // max(1, len(active))))
    return equal


def _around(words: np.ndarray, first: np.ndarray, second: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(which, begin, end): the stretches within [low, high) in which words one period apart are equal as they seem to be at
    ``first`` and ``second``. Of pairs of places in one long stretch the first stands for all."""
    on = _equal_words(words, first, second, np.minimum(high - second, SHORT), 1)
    back = _equal_words(words, first - 1, second - 1, np.minimum(first - low, SHORT), -1)
    long = np.flatnonzero((on == SHORT) | (back == SHORT))
    which = [np.flatnonzero((on < SHORT) & (back < SHORT))]
    begin, end = [first[which[0]] - back[which[0]]], [second[which[0]] + on[which[0]]]
    long = long[np.lexsort((first[long], high[long], low[long], (second - first)[long]))]
    while len(long):
        same = (np.diff(low[long]) == 0) & (np.diff(high[long]) == 0) & (np.diff((second - first)[long]) == 0)
        lead = np.flatnonzero(np.r_[True, ~same])
        one, two = first[long[lead]], second[long[lead]]
        on = _equal_words(words, one, two, high[long[lead]] - two, 1)
        back = _equal_words(words, one - 1, two - 1, one - low[long[lead]], -1)
        which.append(long[lead])
        begin.append(one - back)
        end.append(two + on)
        group = np.cumsum(np.r_[True, ~same]) - 1
        # The places behind these that lie in the same stretch are done; a stretch ends before its first unequal word.
        rest = first[long] > (one + on)[group]
        long = long[rest]
    return np.concatenate(which), np.concatenate(begin), np.concatenate(end)


def runs_at_boundaries(words: np.ndarray, repeated: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(boundary, begin, end, period) of stretches long enough to be runs, around ``middle`` within [low, high).

    ``repeated`` tells of each pair of words whether it occurs again in its text: grams with other pairs are unique.
    """
    n = len(words)
    out: list[tuple] = []
    size, total = GRAM, np.zeros(n + 1, np.int64)
    np.cumsum(repeated, out=total[1:])
    starts = np.flatnonzero(total[GRAM - 1 : n] - total[: n - GRAM + 1] == GRAM - 1) if n >= GRAM else np.empty(0, np.int64)
    # Only the places that can matter carry a gram; ``slot`` finds a place among them.
    gram = np.zeros(len(starts), np.uint64)
    for j in range(GRAM):
        gram = _mixed(gram, words[starts + j].astype(np.uint64))
    while len(starts):
        order = np.lexsort((starts, gram))
        new = np.r_[True, gram[order][1:] != gram[order][:-1]]
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        place, group = starts[order][several], group[several]
        if not len(place):
            break
        group_at = np.full(n + 1, -1, np.int64)
        group_at[place] = group
        listed = group * (n + 1) + place
        nearest, farthest = (1 if size == GRAM else size), 2 * size
        for anchor, onward in ((middle, True), (middle, False), (middle - size, False)):
            fits = np.flatnonzero((anchor >= low) & (anchor + size <= high))
            fits = fits[group_at[anchor[fits]] >= 0]
            here = anchor[fits]
            if onward:
                from_, to = here + nearest, np.minimum(here + farthest, high[fits] - size + 1)
            else:
                from_, to = np.maximum(here - farthest + 1, low[fits]), here - nearest + 1
            to = np.maximum(to, from_)
            base = group_at[here] * (n + 1)
            begin, end = np.searchsorted(listed, base + from_), np.searchsorted(listed, base + to)
            many = end - begin
            cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(many) // CANDIDATES)) + 1, len(many)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if not many[a:b].sum():
                    continue
                whose = np.repeat(np.arange(a, b), many[a:b])
                nth = np.arange(len(whose)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
                other = place[begin[whose] + nth]
                one, two = np.minimum(here[whose], other), np.maximum(here[whose], other)
                edge = fits[whose]
                which, begins, stops = _around(words, one, two, low[edge], high[edge])
                edge, period = edge[which], (two - one)[which]
                long = stops - begins >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
                out.append((edge[long], begins[long], stops[long], period[long]))
        # Grams of twice the length, where both halves occur again.
        kept = np.full(n + 1, -1, np.int64)
        kept[starts] = np.arange(len(starts))
        on = place[(place + size < n)]
        on = np.sort(on[group_at[on + size] >= 0])
        gram = _mixed(gram[kept[on]], gram[kept[on + size]])
        starts, size = on, 2 * size
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _derived(grammar: Grammar, left: np.ndarray, right: np.ndarray, length: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rule, place) of every place at which a rule among ``owners`` is derived."""
    count = len(left)
    holds = np.zeros(count, bool)
    holds[owners] = True
    own, at = holds.copy(), 0
    for made in grammar.left:
        # Rules of a round are made of symbols of earlier rounds.
        rules = np.arange(at, at + len(made))
        for side in (left, right):
            inner = side[rules] - grammar.first
            holds[rules] |= (inner >= 0) & holds[np.maximum(inner, 0)]
        at += len(made)
    rule, place = grammar.symbols - grammar.first, grammar.at
    found: list[tuple] = []
    while True:
        some = (rule >= 0) & holds[np.maximum(rule, 0)] if count else np.zeros(len(rule), bool)
        rule, place = rule[some], place[some]
        if not len(rule):
            break
        found.append((rule[own[rule]], place[own[rule]]))
        first = left[rule] - grammar.first
        size = np.where(first >= 0, length[np.maximum(first, 0)], 1)
        rule, place = np.r_[first, right[rule] - grammar.first], np.r_[place, place + size]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([r for r, _ in found]), np.concatenate([p for _, p in found])


def merged(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """(begin, end, period) of maximal runs, by begin and period: stretches of one period that share a period's words are one
    run, and of runs over the same words the smallest period counts."""
    if not len(begin):
        return begin, end, period
    order = np.lexsort((-end, begin, period))
    begin, end, period = begin[order], end[order], period[order]
    rank = np.cumsum(np.r_[True, period[1:] != period[:-1]])
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(rank * far + end) - rank * far  # greatest end so far, of this period or none
    fresh = np.r_[True, (rank[1:] != rank[:-1]) | (begin[1:] + period[1:] > reach[:-1])]
    starts = np.flatnonzero(fresh)
    begin, end, period = begin[starts], np.maximum.reduceat(end, starts), period[starts]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    smallest = np.r_[True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])]
    begin, end, period = begin[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(begin, end, period) of all maximal runs in texts end to end, by begin and period."""
    if not len(words):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    grammar = re_pair(words, ends)
    left, right, begin, middle, end = grammar.rules()
    length = end - begin
    starts = np.r_[0, ends[:-1]]
    loose = grammar.at[~np.isin(grammar.at, starts)]
    text = np.searchsorted(ends, loose, side="right")
    large = np.flatnonzero(length >= LEAST_WORDS)
    low, high = np.r_[begin[large], starts[text]], np.r_[end[large], ends[text]]
    edge, a, b, period = runs_at_boundaries(words, grammar.repeated, low, np.r_[middle[large], loose], high)
    of_rule = edge < len(large)
    owner = large[edge[of_rule]]
    rule, place = _derived(grammar, left, right, length, np.unique(owner))
    # Every run of a rule at every place of the rule.
    order = np.argsort(rule, kind="stable")
    rule, place = rule[order], place[order]
    from_, to = np.searchsorted(rule, owner), np.searchsorted(rule, owner, side="right")
    which = np.repeat(np.arange(len(owner)), to - from_)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(to - from_) - (to - from_), to - from_)
    shift = place[from_[which] + nth] - begin[owner[which]]
    inner = np.flatnonzero(of_rule)[which]
    outer = np.flatnonzero(~of_rule)
    return merged(np.r_[a[inner] + shift, a[outer]], np.r_[b[inner] + shift, b[outer]], np.r_[period[inner], period[outer]])
