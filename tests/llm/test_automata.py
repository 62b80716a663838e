import random

from hypothesis import given, settings
from hypothesis import strategies as st
from plain import greedy_pieces

from clinflow.llm.automata import LongestMatch, SuffixAutomaton

short = st.lists(st.integers(0, 2), max_size=12)


def places(sequences, part):
    n = len(part)
    return sum(s[i : i + n] == part for s in sequences for i in range(len(s) - n + 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(short, max_size=4), short)
def test_matching_statistics_and_counts(sequences, text):
    automaton = SuffixAutomaton()
    for s in sequences:
        automaton.add(s)
    automaton.count()
    for end, (state, size) in enumerate(automaton.matches(text), 1):
        longest = max(k for k in range(end + 1) if k == 0 or places(sequences, text[end - k : end]))
        assert size == longest
        for k in range(1, size + 1):
            assert automaton.seen[automaton.suffix(state, k)] == places(sequences, text[end - k : end])


def test_sequences_count_as_often_as_said():
    automaton = SuffixAutomaton()
    automaton.add([1, 2, 3], 5)
    automaton.add([2, 3], 2)
    automaton.count()
    state, size = list(automaton.matches([2, 3]))[-1]
    assert size == 2 and automaton.seen[automaton.suffix(state, 2)] == 7


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab ", min_size=1, max_size=5).map(str.encode), max_size=12), st.text("abc", max_size=14).map(str.encode))
def test_longest_match_counts_greedy_pieces(vocabulary, word):
    expected = greedy_pieces(word, vocabulary)
    assert LongestMatch(vocabulary).count(word) == (-1 if expected is None else expected)


def test_a_long_word_takes_one_pass():
    pieces = {b"a" * k for k in (1, 2, 3, 7)} | {b"ab"}
    n, rest = divmod(200_001, 7)
    assert LongestMatch(pieces).count(b"a" * 200_001) == n + {0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2}[rest]


def test_automata_of_random_texts_agree_with_counting():
    rng = random.Random(3)
    sequences = [[rng.randint(0, 3) for _ in range(80)] for _ in range(5)]
    automaton = SuffixAutomaton()
    for s in sequences:
        automaton.add(s)
    automaton.count()
    for s in sequences:
        for end, (state, size) in enumerate(automaton.matches(s), 1):
            assert size == end
            for k in (3, 6, 20):
                if k <= end:
                    assert automaton.seen[automaton.suffix(state, k)] == places(sequences, s[end - k : end])
