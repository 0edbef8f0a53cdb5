"""Chain state in Spark's own store: what waits, what is complete, which token comes next.

:class:`EntityChains` decides for one entity (a mailbox folder, a user's folders, the users, a message). It sees the
links of landed pages, never a body: chain, attempt, page number, landing time, whether the page ends its chain, the
delta link, and where the page lies (file and row). Pages that come and are given out in the same call never enter
the state.

:class:`GroupChains` runs it for a group of entities (a hash of the entity) in one call: a call, and each access to the
state, costs far more than the work on a page, and most entities bring a page or two. What the entities keep lies in
RocksDB without expiry, in leaves of about ``FULL`` entries (:class:`Leaves`); a micro-batch reads and writes the leaves
of the entities that it brings, not what else lies there. Rows, decisions and leaves go as JSON text, one column each.

* A page of the current token is kept until its attempt is complete; then the attempt's pages are given out
  once, the token moves on, and the pages of the closed chain are forgotten. Of attempts that are complete
  together the one that ended last counts. Reruns whose pages are cut differently never add up.
* A page of a later token, or of an entity that is not known yet, waits; tokens that land together are
  followed to the end in the same call, however many they are.
* Pages of closed chains are replays: dropped, or given out again where replays are wanted.
* A chain that ends with the token it was asked with, or with none, stays current: a page landed again in
  the same attempt is dropped, another attempt is a new ask.
"""

from __future__ import annotations

import json
from collections import defaultdict, namedtuple
from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FROM = "kind string, one string, two string, token string, attempt string, page_no int, at long, ends boolean, link string, file string, place long"
GIVEN = "kind string, one string, two string, token string, link string, file string, place long, parent string"
GROUPS = 1_024       # of entities; fixed, since the state is dealt by them
FULL = 100           # entries of a leaf, on average
NEAR = 64            # page numbers of an attempt that lie in one leaf
MOST_GIVEN = 1_000   # decisions in a row of the output
PACKED = "given string"

_text = json.JSONEncoder(separators=(",", ":")).encode
_quoted = json.encoder.encode_basestring_ascii
_Landed = namedtuple("_Landed", "kind one two token attempt page_no at ends link file place")


class EntityChains(StatefulProcessor):
    """``waits_for_parent``: an entity without a stored token is synced only once a parent record names it
    (``kind`` 'parent'); otherwise any landed entity starts with a full load.
    ``per_parent``: each parent record gets the entity's pages (attachments of message records)."""

    def __init__(self, dedupe: bool = True, waits_for_parent: bool = False, per_parent: bool = False):
        self.dedupe, self.waits_for_parent, self.per_parent = dedupe, waits_for_parent, per_parent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "token string")
        self.pages = handle.getMapState("pages", "token string, attempt string, page_no int",
                                        "at long, ends boolean, link string, file string, place long")
        self.attempts = handle.getMapState("attempts", "token string, attempt string",
                                           "pages int, last_no int, top_no int, given boolean")
        self.closed = handle.getMapState("closed", "token string", "link string")
        self.parents = handle.getMapState("parents", "parent string", "given boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.current.update((initialState.token,))

    def _stored(self, place: tuple) -> bool:
        """Whether an earlier call has kept this page; the state is asked only about attempts it knows."""
        return place[:2] in self.before and self.pages.containsKey(place)

    def _page(self, place: tuple) -> tuple:
        return self.held[place] if place in self.held else self.pages.getValue(place)

    def _take(self, row, attempts: dict) -> None:
        """Keep a page; of a page landed twice in one attempt the later landing."""
        place = (row.token, row.attempt, row.page_no)
        pages, last_no, top_no, given = attempts.get(place[:2], (0, -1, -1, False))
        if given:
            return
        if place in self.held or self._stored(place):
            at, ended, *_ = self._page(place)
            if row.at < at:
                return
            if ended and not row.ends and last_no == row.page_no:
                last_no = -1
        else:
            pages += 1
        self.held[place] = (row.at, row.ends, row.link, row.file, row.place)
        attempts[place[:2]] = (pages, max(last_no, row.page_no) if row.ends else last_no, max(top_no, row.page_no), False)

    def _complete(self, token: str, attempts: dict) -> str | None:
        """The complete attempt of the token that ended last."""
        done = [(self._page((token, name, last_no))[0], name) for (of, name), (pages, last_no, _, given) in attempts.items()
                if of == token and not given and last_no >= 0 and pages == last_no + 1]
        return max(done)[1] if done else None

    def _forget(self, of: tuple, attempts: dict) -> None:
        for page_no in range(attempts[of][2] + 1):
            place = (*of, page_no)
            self.held.pop(place, None)
            if self._stored(place):
                self.pages.removeKey(place)

    def _given(self, key, token: str, name: str, last_no: int, parent: str | None = None) -> Iterator[Row]:
        for page_no in range(last_no + 1):
            _, _, _, file, place = self._page((token, name, page_no))
            yield Row(kind="page", one=key[0], two=key[1], token=token, link=None, file=file, place=place, parent=parent)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts = {tuple(k): tuple(v) for k, v in self.attempts.iterator()}
        self.before, self.held, closed = dict(attempts), {}, {}  # a call to the state costs more than the work on a page
        stored = self.current.get()
        known, now = stored is not None, stored[0] if stored is not None else None
        for row in rows:
            if row.kind == "parent":
                known, now = True, now or ""
                if self.per_parent and not self.parents.containsKey((row.link,)):
                    self.parents.updateValue((row.link,), (False,))
                continue
            if row.token not in closed:  # an entity without a current token has closed none
                closed[row.token] = stored is not None and self.closed.containsKey((row.token,))
            if closed[row.token]:
                if not self.dedupe:
                    yield Row(kind="page", one=key[0], two=key[1], token=row.token, link=None, file=row.file, place=row.place, parent=None)
            else:
                known = known or not self.waits_for_parent
                now = now or ("" if known else None)
                self._take(row, attempts)
        if known:
            if self.per_parent:
                yield from self._to_parents(key, attempts, stored)
            else:
                yield from self._follow(key, now, attempts, stored)
        for place, value in self.held.items():
            self.pages.updateValue(place, value)
        for of, value in attempts.items():
            if self.before.get(of) != value:
                self.attempts.updateValue(of, value)
        for of in self.before.keys() - attempts.keys():
            self.attempts.removeKey(of)

    def _follow(self, key, now: str, attempts: dict, stored: tuple | None) -> Iterator[Row]:
        while (name := self._complete(now, attempts)) is not None:
            last_no = attempts[now, name][1]
            link = self._page((now, name, last_no))[2]
            yield from self._given(key, now, name, last_no)
            yield Row(kind="token", one=key[0], two=key[1], token=now, link=link, file=None, place=None, parent=None)
            if link is None or link == now:
                self._forget((now, name), attempts)
                attempts[now, name] = (0, -1, -1, True)
                continue
            for of in [x for x in attempts if x[0] == now]:
                self._forget(of, attempts)
                del attempts[of]
            self.closed.updateValue((now,), (link,))
            now = link
        if stored is None or stored[0] != now:
            self.current.update((now,))

    def _to_parents(self, key, attempts: dict, stored: tuple | None) -> Iterator[Row]:
        if stored is None or stored[0] != "":
            self.current.update(("",))
        name = self._complete("", attempts)
        if name is not None:
            for (parent,), (given,) in list(self.parents.iterator()):
                if not given:
                    yield from self._given(key, "", name, attempts["", name][1], parent)
                    self.parents.updateValue((parent,), (True,))


def _key(*parts) -> str:
    """``parts`` as a JSON array: the key of an entry (made far more often than ``_text``)."""
    return "[" + ",".join([_quoted(p) if isinstance(p, str) else "null" if p is None else str(p) for p in parts]) + "]"


class Leaves:
    """Entries of a group by key, in leaves that are read and written as a whole.

    Linear hashing: the leaves are split one by one as entries come, so a leaf stays small however many there are."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.size = handle.getValueState("size", "leaves int, entries long")
        self.stored = handle.getMapState("leaves", "leaf int", "entries string")

        self.group = None

    def open(self, group: tuple) -> None:
        """To be called for a group before its entries are used; what the same call has just written is still there."""
        if group != self.group:
            self.before = self.n, self.entries = self.size.get() or (1, 0)
            self.group, self.loaded, self.changed = group, {}, set()

    @staticmethod
    def place(key: str, n: int) -> int:
        """The leaf of a key when there are ``n``; pages of an attempt, which come one after the other, lie together."""
        if key.startswith('["page",'):
            attempt, _, page_no = key[:-1].rpartition(",")
            key = f"{attempt},{int(page_no) // NEAR}"
        full = 1 << (n.bit_length() - 1)
        leaf = crc32(key.encode()) & (2 * full - 1)
        return leaf if leaf < n else leaf - full

    def _leaf(self, i: int) -> dict:
        if i not in self.loaded:  # without an entry all leaves are empty or not there
            self.loaded[i] = json.loads(self.stored.getValue((i,))[0]) if self.before[1] else {}
        return self.loaded[i]

    def get(self, key: str):
        return self._leaf(self.place(key, self.n)).get(key)

    def put(self, key: str, value) -> None:
        leaf = self._leaf(i := self.place(key, self.n))
        self.entries += key not in leaf
        leaf[key] = value
        self.changed.add(i)

    def remove(self, key: str) -> None:
        leaf = self._leaf(i := self.place(key, self.n))
        self.entries -= leaf.pop(key, None) is not None
        self.changed.add(i)

    def close(self) -> None:
        n = max(self.n, -(-self.entries // FULL))
        if n >= 2 * self.n:  # each leaf is split
            leaves = [self._leaf(i) for i in range(self.n)]
            self.loaded, self.changed = {i: {} for i in range(n)}, set(range(n))
            for leaf in leaves:
                for k, v in leaf.items():
                    self.loaded[self.place(k, n)][k] = v
        else:
            for new in range(self.n, n):
                old = new - (1 << (new.bit_length() - 1))
                leaf = self._leaf(old)
                self.loaded[new] = {k: leaf.pop(k) for k in [k for k in leaf if self.place(k, new + 1) == new]}
                self.changed |= {old, new}
        self.n = n
        for i in self.changed:
            self.stored.updateValue((i,), (_text(self.loaded[i]),))
        if (self.n, self.entries) != self.before:
            self.size.update((self.n, self.entries))
        self.before, self.changed = (self.n, self.entries), set()


class _Value:
    """An entity's single value, as :class:`EntityChains` sees it."""

    def __init__(self, x):
        self.x = x

    def get(self):
        return self.x

    def update(self, x) -> None:
        self.x = x


class _Few(dict):
    """An entity's map that is read as a whole: it lies in the entity's own entry."""
    containsKey, updateValue, removeKey = dict.__contains__, dict.__setitem__, dict.pop

    def iterator(self):
        return iter(list(self.items()))


class _Many:
    """An entity's map that is read key by key: an entry for each of them."""

    def __init__(self, leaves: Leaves, *name):
        self.leaves, self.name = leaves, name

    def _key(self, key: tuple) -> str:
        return _key(*self.name, *key)

    def containsKey(self, key: tuple) -> bool:
        return self.leaves.get(self._key(key)) is not None

    def getValue(self, key: tuple):
        return self.leaves.get(self._key(key))

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.leaves.put(self._key(key), value)

    def removeKey(self, key: tuple) -> None:
        self.leaves.remove(self._key(key))


class GroupChains(StatefulProcessor):
    """:class:`EntityChains` for all entities of a group.

    Rows come as ``part, row``, the group and the JSON array of the columns ``FROM``; stored tokens as ``row``, a JSON
    array of ``[one, two, token]``; decisions go as ``given``, a JSON array of rows of ``GIVEN``."""

    def __init__(self, chains: EntityChains):
        self.chains = chains

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.leaves = Leaves(handle)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.leaves.open(key)
        for one, two, token in json.loads(initialState.row):
            self.leaves.put(_key("entity", one, two), (token, (), ()))
        self.leaves.close()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        entities: dict[tuple, list] = defaultdict(list)
        files: dict[str, str] = {}  # a file's name is held once
        for _, row in rows:
            kind, one, two, token, attempt, page_no, at, ends, link, file, place = json.loads(row)
            entities[one, two].append(
                _Landed(kind, one, two, token, attempt, int(page_no), int(at), ends == "true", link, files.setdefault(file, file), int(place)))
        self.leaves.open(key)
        given = []
        while entities:
            entity, own = entities.popitem()
            for row in self._entity(entity, own):
                given.append(tuple(row))
                if len(given) == MOST_GIVEN:
                    yield Row(given=_text(given))
                    given = []
        if given:
            yield Row(given=_text(given))
        self.leaves.close()

    def _entity(self, entity: tuple, rows: list) -> Iterator[Row]:
        key, chains = _key("entity", *entity), self.chains
        before = self.leaves.get(key)
        token, attempts, parents = before or (None, (), ())
        chains.current = _Value(None if token is None else (token,))
        chains.attempts = _Few({tuple(x[:2]): tuple(x[2:]) for x in attempts})
        chains.parents = _Few({(parent,): (given,) for parent, given in parents})
        chains.pages, chains.closed = _Many(self.leaves, "page", *entity), _Many(self.leaves, "closed", *entity)
        was = chains.current.x, dict(chains.attempts), dict(chains.parents)
        yield from chains.handleInputRows(entity, iter(rows), None)
        if was != (chains.current.x, chains.attempts, chains.parents):
            self.leaves.put(key, (chains.current.x and chains.current.x[0], [(*k, *v) for k, v in chains.attempts.items()],
                                  [(*k, *v) for k, v in chains.parents.items()]))
