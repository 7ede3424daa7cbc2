"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each character; dynamic programming carries the
best score and its number of pieces, no back pointers. Ties go to the piece that starts first, as starts are tried in
order and only a better score replaces. A character without a piece of its own may also be an unknown one, tried last,
at the lowest score less 10; it counts as its UTF-8 bytes (byte fallback) or as one.

A text gets a leading space and spaces become U+2581. No piece of the usual vocabularies has U+2581 after another
character, so nothing crosses a cut before a run of spaces: words are solved apart and short ones looked up in a table of
bounded size per task. A vocabulary with other pieces is run over the uncut text.

Null and empty texts have no tokens. Repeated rows are counted each.
"""

import re

import ahocorasick
import public_tokenizers
import sentencepiece

from .texts import map_texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizer
KEPT_CHARS = 48
KEPT_WORDS = 300_000

WORDS = re.compile(" *[^ ]+| +")


def read_pieces(path):
    """Ordinary pieces and scores of a vocabulary file; control, byte, unused and unknown entries match no text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_byte, model.is_unused, model.is_unknown)
    ids = [i for i in range(model.get_piece_size()) if not any(test(i) for test in skip)]
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids]


class ViterbiCounter:
    def __init__(self, pieces, byte_fallback=True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.cut = all(SPACE not in piece.lstrip(SPACE) for piece, _ in pieces)
        self.kept = {}

    def solve(self, text):
        """Pieces on the best path through `text`, whose spaces are U+2581 already."""
        score, count, best, single = [0.0], [0], None, False
        for end, (length, gain) in self.automaton.iter(text):
            while len(score) <= end:
                self.settle(text, score, count, best, single)
                best, single = None, False
            start = end + 1 - length
            gain += score[start]
            if best is None or gain > best[0]:
                best = (gain, count[start] + 1)
            if length == 1:
                single = True
        while len(score) <= len(text):
            self.settle(text, score, count, best, single)
            best, single = None, False
        return count[-1]

    def settle(self, text, score, count, best, single):
        """Fix the best path to the end of the next character; without a piece of its own it may be an unknown one."""
        if not single:
            unknown = score[-1] + self.unknown
            if best is None or unknown > best[0]:
                best = (unknown, count[-1] + (len(text[len(score) - 1].encode()) if self.byte_fallback else 1))
        score.append(best[0])
        count.append(best[1])

    def word(self, word):
        """Pieces of a word and the space before it."""
        n = self.solve(SPACE + word.replace(" ", SPACE))
        if len(word) <= KEPT_CHARS:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            self.kept[word] = n
        return n

    def count(self, text):
        if not text:
            return 0
        if not self.cut:
            return self.solve(f" {text}".replace(" ", SPACE))
        if SPACE in text:
            text = text.replace(SPACE, " ")  # the same pieces, and cuts where they belong
        known = self.kept.get
        plain = "  " not in text and text[0] != " " and text[-1] != " "
        words = text.split(" ") if plain else [w[1:] for w in WORDS.findall(f" {text}")]
        return sum([known(w) or self.word(w) for w in words])


def count_tokens(docs, id_col="doc_id", text_col="text", vocabulary=None, byte_fallback=True):
    """One row per document: doc_id, n_tokens, n_chars (code points)."""
    path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    pieces = docs.sparkSession.sparkContext.broadcast(read_pieces(path))

    def start():
        counter = ViterbiCounter(pieces.value, byte_fallback)
        return lambda text: (counter.count(text), len(text))

    return map_texts(docs, id_col, text_col, start, "n_tokens bigint, n_chars bigint")
