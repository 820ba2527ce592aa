"""How much of a text stands in lists of keywords, links, menu entries, tags or wares rather than in sentences.

A text is cut into units at line breaks and sentence ends. A unit is prose if it
has the share of function words that sentences have and does not merely repeat
the text's own keywords. Everything is array work over a batch of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from rostrum.llm.shingles import _BYTE_CODES, _PRIME, mix

# Function words of English, German, French and Spanish, as far as texts of any subject need them.
# Those of the first list make a sentence; those of the second stand in lists too.
SENTENCE_WORDS = """
a an the this that these those each every any no one some both few many another
i you he she it we they me him us them my your his its our their who whom whose which what
but nor if unless until while although though because since when where after before than whether
am is are was were be been being do does did has have had can cannot could will would shall should may might must not never
der die das den dem des ein eine einen einem einer eines dieser diese dieses jeder jede jedes unser unsere mein sein ihr ihre kein keine
aber denn weil wenn obwohl dass ob ist sind war waren hat haben wird werden nicht sich es er sie wir ich du
le la les un une ce cet cette ces mon ma notre nos votre son sa ses leur chaque aucun
mais car si quand parce que qui quoi dont il elle nous vous ils elles je tu ne pas est sont
el los las uno una unos unas este esta estos ese esa esos aquel su sus mi nuestro cada ningun
pero sino porque cuando aunque mientras donde se lo es son ni yo ella ellos nosotros
""".split()
OTHER_WORDS = """
all much such other same own and or so yet as of in on at by for from to into onto upon over under near beyond behind between among against
towards toward through without within about with only also too very there here then now how why again still
und oder ohne als wie auch noch nur von zu mit auf fuer für aus bei nach ueber über unter vor im am zum zur
du au aux et ou donc bien sans avec pour par sur sous dans entre vers
y o con sin sobre bajo hacia desde hasta para por en de del al
""".split()

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(0x80, 256)]] = True


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[[ord(c) for c in chars]] = 1
    return out


_LINE, _STOP, _LIST, _QUOTE = _class("\n\r"), _class(".?!"), _class(",;|>*#+=/-_[]()<&:"), _class("\"'")


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text index, hash, start and end of each word of lower-cased texts."""
    inside = _WORD[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    if len(before):
        before[0] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64), starts, starts
    opens = (~before)[inside]
    first = np.flatnonzero(opens)
    length = np.diff(np.append(first, len(opens)))
    place = np.arange(len(opens)) - np.repeat(first, length)
    powers = np.full(int(length.max()), _PRIME, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes = mix(np.add.reduceat(_BYTE_CODES[data[inside]] * powers[place], first))
    return np.searchsorted(offsets, starts, side="right") - 1, hashes, starts, starts + length


def _known(words: list[str]) -> np.ndarray:
    words = sorted(set(words))
    data = np.frombuffer("".join(words).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(w.encode()) for w in words]))
    return np.unique(hash_words(data, offsets)[1])


#: Words whose dot ends no unit.
_TITLES = _known(["mr", "mrs", "ms", "dr", "prof", "st", "vs"])
_SENTENCE, _FUNCTION = _known(SENTENCE_WORDS), _known(SENTENCE_WORDS + OTHER_WORDS)


def _among(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words


@dataclass
class Units:
    """Per unit: its text, and numbers of words."""

    text: np.ndarray
    words: np.ndarray
    function: np.ndarray
    sentence: np.ndarray
    keyword: np.ndarray
    separators: np.ndarray
    links: np.ndarray
    ended: np.ndarray
    first: np.ndarray
    unit_of_word: np.ndarray


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Units, np.ndarray, np.ndarray]:
    """Units of lower-cased texts, and text index and hash of every word."""
    text, word, start, end = hash_words(data, offsets)
    n = len(text)
    if not n:
        z = np.empty(0, np.int64)
        return Units(z, z, z, z, z, z, z, z.astype(bool), z, z), text, word
    nxt = np.append(start[1:], len(data))
    last_of_text = np.append(text[1:] != text[:-1], True)
    nxt = np.where(last_of_text, offsets[text + 1], nxt)
    run = lambda table: np.append(0, np.cumsum(table[data], dtype=np.int64))
    lines, lists = run(_LINE), run(_LIST)
    line = lines[nxt] > lines[end]
    gap_lists = lists[nxt] - lists[end]
    # a sentence end: a stop right after the word or its closing mark, and a blank or the end behind it
    padded = np.append(data, [32, 32, 32]).astype(np.uint8)
    blank = np.zeros(256, bool)
    blank[[9, 10, 13, 32]] = True
    stop = (_STOP[padded[end]] == 1) & (blank[padded[end + 1]] | (_STOP[padded[end + 1]] == 1) | (_QUOTE[padded[end + 1]] == 1))
    stop &= ~_among(word, _TITLES)
    link = (padded[end] == 58) & (padded[end + 1] == 47) & (padded[np.minimum(end + 2, len(padded) - 1)] == 47)
    cut = line | stop | last_of_text
    unit = np.append(0, np.cumsum(cut)[:-1])
    first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    function, sentence = _among(word, _FUNCTION), _among(word, _SENTENCE)
    order = np.lexsort((word, text))
    t, w = text[order], word[order]
    head = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (w[1:] != w[:-1])))
    size = np.diff(np.append(head, n))
    count = np.empty(n, np.int64)
    count[order] = np.repeat(size, size)
    total = np.bincount(text, minlength=len(offsets) - 1)
    keyword = ~function & (count >= np.maximum(3, 0.03 * total[text]))
    add = lambda x: np.add.reduceat(x.astype(np.int64), first)
    inner = np.where(cut, 0, gap_lists)
    found = Units(text[first], add(np.ones(n)), add(function), add(sentence), add(keyword), add(inner), add(link), np.logical_or.reduceat(stop, first), first, unit)
    return found, text, word
