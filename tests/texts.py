"""Texts for the tests: hand-written ones and random mixes of hard pieces."""

import random

SMALL = '''RATES = {"a": 0.1}


@cached
@traced("rate")
def rate(kind):
    def fallback(why=None):
        return 0.0

    return RATES.get(kind) or fallback()


async def refresh(): await load()
print(rate("a"))
'''

LARGER = '''"""Tides."""
from math import pi

# Heights in metres.
# Times in hours.
class Tide(Base): period = 12.4

@dataclass
# stands between decorator and class
class Harbour:
    depth: float

    @property
    def shallow(self): return self.depth < 2

    def at(self, hour):
        ERRORS = []
        class Local(Tide):
            pass
        return Local

def spring(moon): return pi * moon
for m in range(3):
    spring(m)
'''

# text, chunks in line mode, chunks in top-level mode
COUNTED = [
    ("", 0, 0),
    ("\t\n   \n", 0, 0),
    ("import os; print(os.sep)", 1, 1),
    (SMALL, 3, 2),
    (LARGER, 7, 4),
    ("def a(): pass\r\nclass B:\r\n  def c(self): pass\r\n", 3, 2),
    ("    def inner(): pass\n", 1, 1),
    ("@one\n@two\n# three\ndef f(): pass\nx = f()\n", 2, 1),
]

_PIECES = [
    "def f():", "def f(a, b):", "class A:", "class B(A):", "def f(a) -> int:", "def é(x):",
    "def f(a: int) -> int:", "async def g():", "def f(x=g()):", "class of things: x", "def", "class",
    "def f(a,", "b):", "@deco", "# note", "#", "x = 1", "erro", "ERRO", "", " ", "    ", "\t",
    "\u00a0", "\u3000", "\x1f", "défi:", "日本:", "class 日本:", "def 1x:", "def  two_spaces :",
    "def\u00a0f():", "def f(a)) :", "class K(a)(b):", ")", ":", "(", "😀", "\ufeff",
]
_ENDS = ["\n"] * 12 + ["\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029", ""]


def random_text(rng, plain=False):
    ends = ["\n"] if plain else _ENDS
    out = []
    for _ in range(rng.randrange(0, 14)):
        indent = rng.choice(["", "", "", "    ", "\t", "\u00a0"])
        out.append(indent + rng.choice(_PIECES) + rng.choice(_PIECES[-20:] + [""] * 20) + rng.choice(ends))
    return "".join(out) + rng.choice(["", "", "x", "def z():"])


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return [random_text(rng, plain=i % 3 == 0) for i in range(n)]
