"""The chain state alone (no Spark): any order of landing gives the same pages and tokens."""

import json
import random
from types import SimpleNamespace

from mailsync.streaming.chains import EntityChains, GroupChains


class Value:
    def __init__(self):
        self.x = None

    def exists(self):
        return self.x is not None

    def get(self):
        return self.x

    def update(self, x):
        self.x = x


class Map(dict):
    containsKey = dict.__contains__
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.pop

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, _schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, _key, _value):
        return self.states.setdefault(name, Map())


def start(token=None, **how):
    chains, handle = EntityChains(**how), Handle()
    chains.init(handle)
    if token is not None:
        chains.handleInitialState(("u", "f"), SimpleNamespace(token=token), None)
    return chains, handle.states


def page(token, page_no, last, link=None, attempt="", at=0):
    return SimpleNamespace(kind="page", token=token, attempt=attempt, page_no=page_no, at=at, ends=page_no == last, link=link,
                           file=f"{attempt}/{token}/{page_no}/{at}", place=0)


def parent(name=None):
    return SimpleNamespace(kind="parent", token="", link=name)


def feed(chains, *batches):
    out = []
    for rows in batches:
        out += [(r.kind, r.file if r.kind == "page" else r.link, r.parent) for r in chains.handleInputRows(("u", "f"), iter(rows), None)]
    return out


def test_any_order_gives_each_chain_once_and_leaves_no_page():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.randint(1, 4) for _ in range(rng.randint(1, 6))]
        tokens = ["", *[f"T{k}" for k in range(1, len(sizes) + 1)]]
        landed = []
        for k, n in enumerate(sizes):
            landed += [page(tokens[k], p, n - 1, tokens[k + 1] if p == n - 1 else None, "a", k) for p in range(n)]
            if rng.random() < 0.5:  # a rerun cut differently that never ends
                landed += [page(tokens[k], p, 9, None, "b", k + 50) for p in rng.sample(range(8), rng.randint(1, 4))]
        landed += rng.sample(landed, rng.randint(0, len(landed)))  # replays
        rng.shuffle(landed)
        cuts = sorted(rng.randint(0, len(landed)) for _ in range(3))
        chains, states = start("")
        got = feed(chains, landed[:cuts[0]], landed[cuts[0]:cuts[1]], landed[cuts[1]:cuts[2]], landed[cuts[2]:])
        assert [x for kind, x, _ in got if kind == "token"] == tokens[1:]
        files = [x for kind, x, _ in got if kind == "page"]
        assert files == [f"a/{tokens[k]}/{p}/{k}" for k, n in enumerate(sizes) for p in range(n)]
        assert not states["pages"] and not states["attempts"] and len(states["closed"]) == len(sizes)


def test_cost_of_a_batch_does_not_grow_with_what_was_closed():
    chains, states = start("")
    for k in range(50):
        feed(chains, [page(f"T{k}" if k else "", 0, 0, f"T{k + 1}")])
        assert not states["pages"] and not states["attempts"]


def test_the_attempt_that_ended_last_counts():
    chains, _ = start("")
    got = feed(chains, [page("", 0, 0, "A", "a", 5), page("", 0, 1, None, "b", 1), page("", 1, 1, "B", "b", 9)])
    assert [x for k, x, _ in got if k == "token"] == ["B"]


def test_a_chain_that_ends_with_its_own_token_stays_current():
    chains, _ = start("T")
    one = page("T", 0, 0, "T", "a", 1)
    assert len(feed(chains, [one], [one])) == 2          # its page and its token, the replay is dropped
    assert len(feed(chains, [page("T", 0, 0, "U", "b", 2)])) == 2
    assert [x for k, x, _ in feed(chains, [page("U", 0, 0, None, "c", 3)]) if k == "token"] == [None]


def test_entities_wait_for_their_parent():
    chains, _ = start(waits_for_parent=True)
    rows = [page("", 0, 0, "T")]
    assert feed(chains, rows) == []
    assert [k for k, *_ in feed(chains, [parent()])] == ["page", "token"]
    assert feed(chains, [parent()], rows) == []


def test_each_parent_gets_the_pages_once():
    chains, _ = start(waits_for_parent=True, per_parent=True)
    assert feed(chains, [parent("m1")]) == []
    assert [p for *_, p in feed(chains, [page("", 0, 1), page("", 1, 1)])] == ["m1", "m1"]
    assert feed(chains, [parent("m1"), page("", 0, 1)]) == []
    assert [p for *_, p in feed(chains, [parent("m2")])] == ["m2", "m2"]


def test_replays_come_again_where_they_are_wanted():
    chains, _ = start("", dedupe=False)
    rows = [page("", 0, 0, "T")]
    assert [k for k, *_ in feed(chains, rows, rows)] == ["page", "token", "page"]


def test_pages_that_are_given_out_at_once_never_enter_the_state():
    chains, states = start("")
    calls = []

    class Counted(Map):
        def __getattribute__(self, name):
            if name in ("containsKey", "getValue", "updateValue", "removeKey"):
                calls.append(name)
            return super().__getattribute__(name)

    chains.pages, chains.closed = Counted(), Counted()
    got = feed(chains, [page("", n, 99, "T" if n == 99 else None) for n in range(100)])
    assert len(got) == 101 and not chains.pages
    assert len(calls) <= 2  # whether the token is closed, and that it is now


class Stored(Map):
    """Counts calls; values go as text, as to the state."""
    calls = 0

    def getValue(self, key):
        Stored.calls += 1
        return self[key]

    def updateValue(self, key, value):
        Stored.calls += 1
        self[key] = value


def group(known=(), **how):
    chains, handle = GroupChains(EntityChains(**how)), Handle()
    handle.states["leaves"] = Stored()
    chains.init(handle)
    if known:
        chains.handleInitialState((0,), SimpleNamespace(row=json.dumps(known)), None)
    return chains, handle.states


def to_row(entity, x):
    at = ["", "0", "0", "false"] if x.kind == "parent" else [x.attempt, str(x.page_no), str(x.at), str(x.ends).lower()]
    return 0, json.dumps([x.kind, *entity, x.token, *at, x.link, getattr(x, "file", None), "0"])


def feed_group(chains, rows, now):
    """One call, by a worker that has nothing but the state."""
    worker = GroupChains(chains.chains)
    worker.init(now)
    return [g for r in worker.handleInputRows((0,), iter(rows), None) for g in json.loads(r.given)]


def test_a_group_decides_as_each_entity_alone():
    rng = random.Random(2)
    for per_parent in (False, True):
        how = {"waits_for_parent": True, "per_parent": per_parent}
        entities = [("u", f"f{n}") for n in range(300)] + [("", ""), ("u\"\\", "\u00e9\x00"), (None, "m")]
        known = [] if per_parent else [(*e, "T0") for e in entities[::3]]
        alone = {e: start("T0" if (*e, "T0") in known else None, **how) for e in entities}
        grouped, states = group(known, **how)
        handle = SimpleNamespace(getValueState=lambda n, _: states[n], getMapState=lambda n, *_: states[n])  # noqa: B023
        for _ in range(4):
            rows = []
            for e in rng.sample(entities, 200):
                for _ in range(rng.randint(0, 4)):
                    token, attempt = "" if per_parent else rng.choice(["", "T0", "T1", "T2"]), rng.choice(["", "x"])
                    last = 1 if attempt else 0
                    rows.append((e, parent(rng.choice(["a", "b"]) if per_parent else None) if rng.random() < 0.4 else page(
                        token, rng.randint(0, last), last, rng.choice([None, "T1", "T2"]), attempt, rng.randint(0, 9))))
            rng.shuffle(rows)
            got = feed_group(grouped, [to_row(e, x) for e, x in rows], handle)
            for e in entities:
                mine = [tuple(g) for g in got if (g[1], g[2]) == e]
                want = [tuple(r) for r in alone[e][0].handleInputRows(e, iter([x for of, x in rows if of == e]), None)]
                assert mine == want
        kept = {k: v for leaf, in states["leaves"].values() for k, v in json.loads(leaf).items()}
        assert len(kept) == states["size"].x[1] and states["size"].x[0] == len(states["leaves"]) > 1
        for e in entities:
            pages = {tuple(json.loads(k)[3:]): tuple(v) for k, v in kept.items() if json.loads(k)[:3] == ["page", *e]}
            assert pages == {k: tuple(v) for k, v in alone[e][1]["pages"].items()}
            closed = {tuple(json.loads(k)[3:]) for k in kept if json.loads(k)[:3] == ["closed", *e]}
            assert closed == set(alone[e][1]["closed"])


def test_entities_of_a_group_share_calls_to_the_state():
    grouped, states = group(waits_for_parent=True, per_parent=True)
    handle = SimpleNamespace(getValueState=lambda n, _: states[n], getMapState=lambda n, *_: states[n])
    rows = [to_row(("u", str(n)), x) for n in range(5_000) for x in (page("", 0, 0), parent("m"))]
    Stored.calls = 0
    assert len(feed_group(grouped, rows, handle)) == 5_000
    assert Stored.calls <= 5_000 / 20
    Stored.calls = 0  # what comes later costs its own leaves, not all that lie there
    assert len(feed_group(grouped, [to_row(("u", "7"), parent("n"))], handle)) == 1
    assert Stored.calls <= 4 and len(states["leaves"]) >= 50
    assert max(len(json.loads(leaf)) for leaf, in states["leaves"].values()) < 1_000
