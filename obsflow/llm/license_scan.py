"""Licence spans from a generalised suffix automaton over the words of licence templates.

A text's words stream through the automaton, which gives at each word the longest run of words ending there that stands
in any template (matching statistics). Runs that cannot grow further and have `MIN_WORDS` words or more are chained per
template, in order in both text and template. A run that a template has at several places may stand for any of them: of
all chains of (run, place) the one that covers most words of the template is a span, then the best of what lies before
and after it, so that spans of one template do not overlap. A span that covers `MIN_COVER` of its template's words adds
the template's label. Phrases are templates too: a phrase ends at a word when its state lies on the suffix path.

Words are maximal runs of 0-9, a-z after lower-casing A-Z, and anything beyond ASCII. Null and empty texts have no words
and no labels; repeated rows are scanned each; an empty table gives no rows; other columns are not read, whatever their
names. Of chains that cover as much, the shorter span counts, then the later one. A run looks back over `MAX_GAP` words
for those it can follow, and a text's runs of `MIN_WORDS` words are all that is held beside its words.
"""

from .texts import map_texts

# Phrases with their labels, and opening words of well-known licence notices.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
        "gpl",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        "apache",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        "mpl",
    ),
)
MIN_WORDS = 4  # of a match
MIN_COVER = 0.6  # of a template's words, for its label
MAX_GAP = 20  # words of the text between two matches of a chain

WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text):
    """Words as bytes: anything that is no word byte becomes a space, A-Z small letters."""
    return text.encode().translate(WORD_BYTES).split()


class SuffixAutomaton:
    """All runs of words of the templates. `places[state]` lists (template, position after the run's last word)."""

    def __init__(self, sequences):
        self.next, self.link, self.length, self.places = [{}], [-1], [0], [[]]
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                self.places[last].append((number, at + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            up = self.places[self.link[state]]
            up.extend(p for p in self.places[state] if p not in up)

    def _state(self, length, following=None, link=-1):
        self.next.append(dict(following or {}))
        self.link.append(link)
        self.length.append(length)
        self.places.append([])
        return len(self.next) - 1

    def _split(self, before, word, state):
        """The state for runs of `length[before] + 1` words, cut off from a state that stands for longer ones too."""
        if self.length[state] == self.length[before] + 1:
            return state
        short = self._state(self.length[before] + 1, self.next[state], self.link[state])
        self.link[state] = short
        while before != -1 and self.next[before].get(word) == state:
            self.next[before][word] = short
            before = self.link[before]
        return short

    def _extend(self, last, word):
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, at = self._state(self.length[last] + 1), last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        self.link[new] = 0 if at == -1 else self._split(at, word, self.next[at][word])
        return new


def _lengthen(chains, run, max_gap):
    """Add a run (start, end, place it ends at) with the best chain that ends with it.

    Rows of `chains`: start, end, place, covered, start of the chain, and which row so far has the best chain.
    """
    start, end, to = run
    covered, first = end - start, start
    for _, before_end, before_to, before, before_first, _ in reversed(chains):
        if start - before_end > max_gap:
            break
        if before_end < end and before_to < to:
            both = before + min(end - start, end - before_end, to - before_to)
            if (both, before_first) > (covered, first):
                covered, first = both, before_first
    best = len(chains)
    if chains:
        other = chains[chains[-1][5]]
        if (other[3], other[4] - other[1]) > (covered, first - end):
            best = chains[-1][5]
    chains.append((start, end, to, covered, first, best))


def chain_spans(runs, min_words, max_gap):
    """Spans (start, end, covered words) of one template, by start. runs: (start, end, place), in order of end.

    The best chain of all is taken first; runs after it, cut where they overlap it, are chained anew, and those before
    it keep their chains.
    """
    spans, todo = [], [runs]
    while todo:
        chains = []
        for run in todo.pop():
            _lengthen(chains, run, max_gap)
        while chains:
            best = chains[-1][5]
            _, end, _, covered, first, _ = chains[best]
            spans.append((first, end, covered))
            after = [(max(s, end), e, to) for s, e, to, *_ in chains[best + 1 :] if e - max(s, end) >= min_words]
            if after:
                todo.append(after)
            before = []
            while chains and chains[-1][1] > first:
                s, e, to, *_ = chains.pop()
                if first - s >= min_words:
                    before.append((s, first, to - (e - first)))
            for run in reversed(before):
                _lengthen(chains, run, max_gap)
    return sorted(spans)


class LicenseScanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES, min_words=MIN_WORDS, min_cover=MIN_COVER, max_gap=MAX_GAP):
        texts = [*phrases, *templates]
        sequences = [words_of(text) for text, _ in texts]
        self.labels = [label for _, label in texts]
        self.sizes = [len(s) for s in sequences]
        self.n_phrases = len(phrases)
        self.min_words, self.min_cover, self.max_gap = min_words, min_cover, max_gap
        self.known = {word: n for n, word in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        numbered = [[self.known[w] for w in s] for s in sequences]
        self.automaton = SuffixAutomaton(numbered)
        self.phrases_at = self._phrase_ends(numbered[: self.n_phrases])

    def _phrase_ends(self, phrases):
        """state -> phrases that end every run of that state which is long enough."""
        own = {}
        for number, words in enumerate(phrases):
            state = 0
            for word in words:
                state = self.automaton.next[state][word]
            own.setdefault(state, []).append(number)
        ends = {}
        for state in range(1, len(self.automaton.next)):
            found, at = [], state
            while at > 0:
                found += own.get(at, [])
                at = self.automaton.link[at]
            if found:
                ends[state] = found
        return ends

    def matches(self, words):
        """(end, length, state) after each word of the vocabulary: the longest run ending there, of any template."""
        following, link, lengths = self.automaton.next, self.automaton.link, self.automaton.length
        state = length = 0
        last = -2
        known = self.known.get
        for at, word in [(i, n) for i, n in enumerate(map(known, words)) if n is not None]:
            if at != last + 1:
                state = length = 0
            last = at
            while state and word not in following[state]:
                state = link[state]
                length = lengths[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            else:
                length = 0
            yield at + 1, length, state

    def scan(self, text):
        """(number of words, places of phrases [(start, phrase)], spans [(start, end, template, covered words)])."""
        words = words_of(text)
        places, runs = [], {}
        previous = None
        for end, length, state in self.matches(words):
            for number in self.phrases_at.get(state, ()):
                if self.sizes[number] <= length:
                    places.append((end - self.sizes[number], number))
            if previous and (end != previous[0] + 1 or length != previous[1] + 1):
                self._place(runs, *previous)
            previous = (end, length, state)
        if previous:
            self._place(runs, *previous)
        spans = [
            (start, end, number, covered)
            for number, found in runs.items()
            for start, end, covered in chain_spans(found, self.min_words, self.max_gap)
        ]
        return len(words), places, sorted(spans)

    def _place(self, runs, end, length, state):
        """Note a run that cannot grow at every place of the templates it stands in."""
        if length < self.min_words:
            return
        for number, to in sorted(self.automaton.places[state]):
            if number >= self.n_phrases:
                runs.setdefault(number, []).append((end - length, end, to))

    def summary(self, text):
        n_words, places, spans = self.scan(text)
        covers = [(covered / self.sizes[number], number) for _, _, number, covered in spans]
        base = {self.labels[number] for _, number in places}
        more = {self.labels[number] for cover, number in covers if cover >= self.min_cover}
        score = 1.0 if places else max([cover for cover, _ in covers], default=0.0)
        starts = [start for start, _ in places]
        return (
            n_words,
            len(places),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | more)),
            score,
            [(start, end, self.labels[number], covered / self.sizes[number]) for start, end, number, covered in spans],
        )


def scan_licenses(docs, id_col="doc_id", text_col="text", phrases=PHRASES, templates=TEMPLATES):
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: start and end word, label and covered share of the template, for every chain of matches.
    """

    def start():
        scanner = LicenseScanner(phrases, templates)

        def work(text):
            *plain, spans = scanner.summary(text)
            return *plain, [dict(zip(("start", "end", "label", "cover"), s)) for s in spans]

        return work

    return map_texts(
        docs,
        id_col,
        text_col,
        start,
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, spans array<struct<start: bigint, end: bigint, label: string, cover: double>>",
    )
