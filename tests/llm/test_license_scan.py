import itertools
import random

import numpy as np
import pytest
from brute import alphanumeric
from lakejobs.llm.license_scan import BASE_PHRASES, TEMPLATES, Scanner, SuffixAutomaton, scan_licenses
from lakejobs.llm.words import hash_word


def base(text):
    words = alphanumeric(text)
    found = []
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    places = sorted(i for i, _ in found)
    ends = (places[0], places[-1]) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted({x for _, x in found})))


def test_base_equals_plain_search(documents, real_texts):
    odd = [
        None, "", "mit", "MIT License", "mit, license mit-license mitlicense MİT license", "the gnu general public license",
        "gnu general\npublic license general public license", "apache apache license license mit mit license mit license",
        "x " * 30_000 + "mit license",
    ]
    rows = [*enumerate(odd), *((1000 + i, text) for i, text in real_texts), (None, "mit license")]
    got = {r.doc_id: r for r in scan_licenses(documents(rows, extra=["labels", "spans"])).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


def test_templates_are_covered(documents):
    half = TEMPLATES["bsd"].split()
    texts = [
        TEMPLATES["mit"],
        "before " + TEMPLATES["apache"].upper() + " after",
        " ".join(half[: len(half) // 4]),
        TEMPLATES["gpl"].replace("WITHOUT ANY WARRANTY", "with no promise"),
        TEMPLATES["mit"] + " " + TEMPLATES["unlicense"],
        "permission is granted to use copy and modify",
    ]
    rows = scan_licenses(documents(texts)).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit", "apache", "", "gpl", "mit,unlicense", ""]
    assert rows[0].score == rows[1].score == rows[4].score == 1.0
    assert 0.2 < rows[2].score < 0.5 and 0.8 < rows[3].score < 1 and rows[5].score == 0.0
    span = rows[1].spans[0]
    assert (span.label, span.start, span.end) == ("apache", 1, rows[1].n_words - 1)


def test_matching_statistics_are_the_longest_stretches():
    rng = random.Random(4)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(6)]
    automaton = SuffixAutomaton()
    for i, x in enumerate(sequences):
        automaton.add(i, x)
    automaton.spread()
    stretches = {tuple(x[i:j]): (k, j - 1) for k, x in reversed(list(enumerate(sequences))) for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    text = [rng.randrange(4) for _ in range(400)]
    for i, (state, length) in enumerate(automaton.statistics(text)):
        longest = next(n for n in range(i + 1, -1, -1) if n == 0 or tuple(text[i + 1 - n : i + 1]) in stretches)
        assert length == longest
        if length:
            here = text[i + 1 - length : i + 1]
            places = {(k, j + length - 1) for k, x in enumerate(sequences) for j in range(len(x)) if x[j : j + length] == here}
            assert automaton.ends[state] == places


def test_empty_table(documents):
    assert scan_licenses(documents([])).collect() == []


def scanned(scanner, words):
    return scanner.scan(scanner.known(np.array([hash_word(x) for x in words], np.uint64)))["spans"]


def all_stretches(template, words, least):
    """(start, place in the template, length) of all that cannot be made longer, word by word."""
    out = set()
    for shift in range(-len(words), len(template)):
        same = [0 <= i + shift < len(template) and template[i + shift] == x for i, x in enumerate(words)]
        for equal, group in itertools.groupby(range(len(words)), key=same.__getitem__):
            where = list(group)
            if equal and len(where) >= least:
                out.add((where[0], where[0] + shift, len(where)))
    return sorted(out)


def best_cover(parts, size):
    """The most words that a chain covers, over all choices of stretches."""
    best = 0
    for n in range(1, len(parts) + 1):
        for chain in itertools.combinations(parts, n):
            total, fits = chain[0][2], True
            for (s, a, n1), (s2, a2, n2) in itertools.pairwise(chain):
                shared = max(0, s + n1 - s2, a + n1 - a2)
                fits = fits and s < s2 and a < a2 and shared < n2 and s2 - s - n1 <= size
                total += n2 - shared
            if fits:
                best = max(best, total)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_best_chain_of_each_template(seed):
    """Shuffled, repeated and truncated pieces of templates that share words, against all choices."""
    rng = random.Random(seed)
    letters = [chr(97 + k) for k in range(4 if seed % 2 else 9)]
    templates = {str(k): " ".join(rng.choices(letters, k=rng.randrange(8, 20))) for k in range(3)}
    words = []
    for _ in range(4):
        source = rng.choice(list(templates.values())).split()
        low = rng.randrange(len(source))
        words += source[low : low + rng.randrange(3, 20)] + ["filler"] * rng.randrange(3)
    scanner = Scanner(templates, {}, 3, 0.5)
    spans = scanned(scanner, words)
    for k, template in enumerate(templates.values()):
        template = template.split()
        parts = all_stretches(template, words, 3)
        own = [x for x in spans if x[2] == k]
        assert bool(own) == bool(parts)
        if len(parts) <= 14 and parts:
            assert max(x[3] for x in own) == pytest.approx(best_cover(parts, len(template)) / len(template))
        assert all(0 < x[3] <= 1 and 0 <= x[0] < x[1] <= len(words) for x in own)


@pytest.mark.parametrize("label", sorted(TEMPLATES))
def test_whole_texts_are_found_after_parts_of_themselves(documents, label):
    words = alphanumeric(TEMPLATES[label])
    whole, tail, half = " ".join(words), " ".join(words[-30:]), len(words) // 2
    texts = [
        f"{tail} filler {whole}",
        f"{whole} {whole}",
        " ".join(words[half:] + ["filler"] + words[:half]),
        f"{whole} " * 200,
        " ".join(words[:half] + ["filler"] + words[half:]),
    ]
    rows = scan_licenses(documents(texts)).orderBy("doc_id").collect()
    for k in (0, 1, 3):
        assert label in rows[k].labels.split(",") and rows[k].score == 1.0
    assert len([x for x in rows[1].spans if x.label == label and x.cover == 1]) == 2
    assert len([x for x in rows[3].spans if x.label == label and x.cover == 1]) == 200
    assert max(x.cover for x in rows[2].spans if x.label == label) == pytest.approx(max(half, len(words) - half) / len(words), abs=0.02)
    assert rows[4].score > 0.5
