import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import conversation_repair as cr
from odd_rows import small

CONV = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
INSIDE = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """(role, text, must go, truncated) and the three counts."""
    seen, out, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        blank = not INSIDE.search(text)
        again = not blank and (role, text) in seen
        cut = not blank and not again and INSIDE.findall(text)[-1] not in ".!?"
        seen.add((role, text))
        counts = [n + f for n, f in zip(counts, (blank, again, cut))]
        out.append((role, text, blank or again, cut))
    return out, counts


def by_enumeration(rows):
    """Every edit of every row, and up to two inserts at every place."""
    marked, _ = faults(rows)
    inserts = ["", "u", "a", "ua", "au"]
    full = {"u": "user", "a": "assistant"}
    best = None
    for gaps in itertools.product(inserts, repeat=len(marked) + 1):
        for edits in itertools.product(["K", "Ru", "Ra", "D"], repeat=len(marked)):
            cost, audit, roles, lines = 0, "", "", []
            for i in range(len(marked) + 1):
                for x in gaps[i]:
                    cost, audit, roles = cost + 5, audit + "I", roles + x
                    lines.append(f"{full[x]}:")
                if i == len(marked):
                    break
                role, text, must_go, cut = marked[i]
                e = edits[i]
                if must_go and e != "D":
                    break
                audit += e[0]
                if e == "D":
                    cost += 2
                else:
                    role = role if e == "K" else full[e[1]]
                    cost += 5 * cut + (e != "K")
                    roles += role[:1] or "?"
                    lines.append(f"{role}:{text}")
            else:
                continue
            if i < len(marked) or not re.fullmatch("(s?(ua)+)?", roles):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = cost, audit, "\n".join(lines)
    return best


def by_strings(rows):
    """The same by a table of whole audits and texts."""
    marked, _ = faults(rows)
    after = {"": "us", "s": "u", "u": "a", "a": "u"}

    def inserted(table):
        out = dict(table)
        for _ in range(2):
            for s, (c, a, lines) in list(out.items()):
                role = "assistant" if s == "u" else "user"
                new = (c + 5, a + "I", (*lines, f"{role}:"))
                if role[0] not in out or new < out[role[0]]:
                    out[role[0]] = new
        return out

    table = {"": (0, "", ())}
    for role, text, must_go, cut in marked:
        new = {}

        def offer(s, c, a, lines, new=new):
            if s not in new or (c, a) < new[s][:2]:
                new[s] = (c, a, lines)

        for s, (c, a, lines) in inserted(table).items():
            offer(s, c + 2, a + "D", lines)
            if not must_go:
                if role[:1] and role[:1] in after[s]:
                    offer(role[:1], c + 5 * cut, a + "K", (*lines, f"{role}:{text}"))
                to = "assistant" if s == "u" else "user"
                offer(to[0], c + 5 * cut + 1, a + "R", (*lines, f"{to}:{text}"))
        table = new
    c, a, lines = min(v for s, v in inserted(table).items() if s in ("", "a"))
    return c, a, "\n".join(lines)


def brute_force(table):
    convs = defaultdict(list)
    for c, t, role, text in table:
        convs[c]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t is not None, t or 0, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    out = []
    for c, rows in convs.items():
        rows = sorted(rows)
        turns = {r[1] for r in rows if r[0]}
        pairs = [r[2:] for r in rows]
        cost, audit, lines = by_strings(pairs)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        out.append((c, gaps, *faults(pairs)[1], illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


TURN = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b!", "c", " ", "d. \t"]))


@settings(max_examples=60, deadline=None)
@given(st.lists(TURN, max_size=2))
def test_cheapest_of_all_edits(rows):
    cost, audit, lines = by_enumeration(rows)
    made = cr.repair([(0, *r) for r in rows])
    assert made[5:] == (cost, audit, hashlib.sha256(lines.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(TURN, max_size=14))
def test_long_ones_by_strings(rows):
    cost, audit, lines = by_strings(rows)
    assert cr.repair([(None, *r) for r in rows])[5:] == (cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def test_audits_are_compared_as_texts():
    draw, audits, texts = random.Random(2), cr.Audits(), [""]
    for _ in range(400):
        parent, piece = draw.randrange(len(texts)), draw.choice(["D", "K", "DD", "KDI", "IIIIIII"])
        audits.add(parent, piece)
        texts.append(texts[parent] + piece)
    for _ in range(3000):
        x, y = draw.randrange(401), draw.randrange(401)
        a, b = draw.choice(["", "D", "K"]), draw.choice(["", "D", "K"])
        assert audits.text(x) == texts[x]
        assert audits.less(x, a, y, b) == (texts[x] + a < texts[y] + b)


def test_collisions_of_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(cr, "MOD", 2)
    test_audits_are_compared_as_texts()


def odd_rows():
    draw, rows = random.Random(8), [(None, 1, "user", "x."), (None, 2, None, None), (900, None, None, "y!"), (901, 1, "", "")]
    for c in range(80):
        for t in range(draw.choice([1, 1, 4, 9, 17])):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
            rows.append((c, draw.choice([t, t, t + 1, None]), role, draw.choice(["Hi.", "Ünd", "ok?", None, "", "\n", "done! "])))
    rows += [(7, 3, "user", "Hi.")] * 5 + [(5000, t, ["user", "assistant"][t % 2], f"line {t % 50}.") for t in range(120)]
    rows += [(8, 100, "user", "y" * 90_000 + ".")]
    draw.shuffle(rows)
    return rows


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in odd_rows()], f"{CONV}, slot int, audit string")


def test_odd_rows(odd):
    assert got(cr.repair_conversations(cr.damaged(odd))) == brute_force(odd_rows())
    assert got(cr.repair_conversations(cr.damaged(odd.limit(0)))) == []


@pytest.mark.parametrize("rows", [-1, 20])
def test_by_blocks(odd, monkeypatch, rows):
    monkeypatch.setattr(cr, "LONG_ROWS", rows)
    monkeypatch.setattr(cr, "BLOCK", 3)
    many = type(odd).repartitionByRange
    monkeypatch.setattr(type(odd), "repartitionByRange", lambda self, *c: many(self, 40, *c))
    assert got(cr.repair_conversations(cr.damaged(odd))) == brute_force(odd_rows())


def test_table(spark):
    table = small(spark, "conversations", "/root/testdata/sf0.01")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(cr.repair_conversations(cr.damaged(table))) == brute_force(rows)
