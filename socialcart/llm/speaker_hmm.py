"""A hidden Markov model over the lines of a transcript (numpy).

A state is a role and whether the line begins a turn or goes on with it.  A
line shows five features: the speaker marker it starts with, what is before it,
its length, how it ends and how it starts; they count as independent given
the state.  Blank lines are no observations, but a feature of the next line.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

ROLES = ("system", "user", "assistant")
STATES = [(r, begins) for r in range(len(ROLES)) for begins in (True, False)]

# Words that name a speaker.
SPEAKERS = {
    "system": ("system", "instructions", "instruction", "context"),
    "user": ("user", "human", "customer", "client", "question", "q", "me", "prompter"),
    "assistant": ("assistant", "ai", "bot", "chatbot", "agent", "answer", "a", "model"),
}
_ROLE_OF = {word: ROLES.index(role) for role, words in SPEAKERS.items() for word in words}
_MARKER = re.compile(r"""\s{0,8}(?:\#{1,6}\s+|<\|(?:im_start\|>)?|\[|\*\*|__|>\s)?\s?
                         (?P<name>[A-Za-z][A-Za-z_]{0,30})\s?
                         (?P<mark>:\*\*|\*\*:|:__|__:|\|>|\]:?|:|\s*\Z)\s?""", re.X)
_OPENS = re.compile(r"\s{0,8}(?:\#{1,6}\s|<\||\[)")

SIZES = (5, 3, 8, 4, 4)
NONE, OTHER = 3, 4  # marker classes after the three roles


def marker(line: str) -> tuple[int, int]:
    """(class, length of the marker): a role, NONE or OTHER (a name that is
    no known speaker)."""
    m = _MARKER.match(line)
    if not m or (not m["mark"].strip() and not _OPENS.match(line)):
        return NONE, 0
    role = _ROLE_OF.get(m["name"].lower())
    return (OTHER, 0) if role is None else (role, m.end())


def features(lines: list[str]) -> np.ndarray:
    """A row for each line that is not blank."""
    out, before = [], 2
    for line in lines:
        text = line.strip()
        if not text:
            before = max(before, 1)
            continue
        kind, size = marker(line)
        body = line[size:].strip()
        length = min(7, len(body).bit_length() // 2 + (len(body) > 0))
        last, first = body[-1:], body[:1]
        ends = 0 if last == "?" else 1 if last in ".!…" and last else 2 if last == ":" else 3
        starts = 0 if first.isupper() else 1 if first.islower() else 2 if first.isdigit() or first in "-*•" and first else 3
        out.append((kind, before, length, ends, starts))
        before = 0
    return np.array(out, np.int64).reshape(-1, len(SIZES))


@dataclass
class SpeakerModel:
    initial: np.ndarray  # log probabilities
    moves: np.ndarray
    emits: list[np.ndarray]

    @classmethod
    def from_counts(cls, counts: dict[tuple[int, int, int], int]) -> SpeakerModel:
        """From (table, row, column) → count; table 0: first states, 1: moves,
        2 and on: features.  Unseen moves and values get half a count; a turn
        never goes on with another role."""
        n = len(STATES)
        tables = [np.zeros((1, n)), np.zeros((n, n)), *(np.zeros((n, k)) for k in SIZES)]
        for (table, i, j), c in counts.items():
            tables[table][i, j] += c
        tables = [t + 0.5 for t in tables]
        for j, (role, begins) in enumerate(STATES):
            if not begins:
                tables[0][0, j] = 0
                for i, (before, _) in enumerate(STATES):
                    if before != role:
                        tables[1][i, j] = 0
        with np.errstate(divide="ignore"):
            logs = [np.log(t / t.sum(axis=1, keepdims=True)) for t in tables]
        return cls(logs[0][0], logs[1], logs[2:])

    def viterbi(self, seen: np.ndarray) -> list[int]:
        """The likeliest states of a transcript's lines; ties go to the state
        that comes first."""
        if not len(seen):
            return []
        emit = sum(e[:, seen[:, k]] for k, e in enumerate(self.emits)).T
        score, back = self.initial + emit[0], []
        for row in emit[1:]:
            way = score[:, None] + self.moves
            best = way.argmax(axis=0)
            back.append(best)
            score = way[best, np.arange(len(STATES))] + row
        path = [int(score.argmax())]
        for best in reversed(back):
            path.append(int(best[path[-1]]))
        return path[::-1]


def count_turns(turns: list[tuple[str, str]], counts: dict) -> None:
    """Add a transcript whose (role, written turn) are known to ``counts``."""
    lines, states = [], []
    for role, written in turns:
        if role not in ROLES:
            continue
        begins = True
        for line in written.split("\n"):
            lines.append(line)
            if line.strip():
                states.append(STATES.index((ROLES.index(role), begins)))
                begins = False
        if begins:  # nothing but blanks: no line to learn from
            continue
    seen = features(lines)
    for k, state in enumerate(states):
        key = (0, 0, state) if k == 0 else (1, states[k - 1], state)
        counts[key] = counts.get(key, 0) + 1
        for f in range(len(SIZES)):
            key = (2 + f, state, int(seen[k, f]))
            counts[key] = counts.get(key, 0) + 1


def split_turns(model: SpeakerModel, transcript: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a transcript, markers taken off."""
    lines = transcript.split("\n")
    path = iter(model.viterbi(features(lines)))
    turns: list[tuple[str, list[str]]] = []
    for line in lines:
        if not line.strip():
            if turns:
                turns[-1][1].append("")
            continue
        role, begins = STATES[next(path)]
        if begins or not turns:
            kind, size = marker(line)
            turns.append((ROLES[role], [line[size:] if kind < NONE else line]))
        else:
            turns[-1][1].append(line)
    return [(role, "\n".join(text).strip()) for role, text in turns]
