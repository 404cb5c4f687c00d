"""Shortest paths by auction over the lattice of edits of a conversation.

A node is a number of rows done and a state of the grammar of roles: 0 nothing
yet, 1 a system turn, 2 a user turn waits for its answer, 3 the answer is there.
Arcs are the edits with their integer costs. Every node has a price, at most the
cost of any arc out of it plus the price at its end. A path grows from the
origin: where the price of its last node equals the cheapest arc plus the price
behind it, the path is extended by that arc; where it is less, the price is
raised to it and the path contracts by one node. When the path arrives, the
arcs whose price difference is their cost (tight arcs) hold all cheapest paths,
and the least sequence of labels is traced over them.
"""

STATES = 4
#: Node prices never pass the cost of deleting all rows, so this marks what can't be reached.
NEVER = 1 << 60
#: By state: the state after a turn of that initial.
NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: By state: the role a new or renamed turn has, and the state after it.
NEEDED = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]
#: The state is a whole conversation.
WHOLE = (0, 3)
RENAME, DELETE, INSERT, UNENDED = 2, 3, 2, 1

_arcs = {}


def row_arcs(initial, fault):
    """By state the arcs over one row: (label, cost, state after it); labels in order.

    ``fault``: empty, or the row's first fault. Blank and repeated rows can only
    be deleted; a truncated one costs more if it stays. A role without letters
    leaves the state as it is.
    """
    key = (initial, fault)
    if key not in _arcs:
        gone = fault in ("blank", "duplicate")
        more = UNENDED if fault == "truncated" else 0
        by_state = []
        for state in range(STATES):
            arcs = [("D", DELETE, state)]
            if not gone:
                after = state if initial == "" else NEXT[state].get(initial)
                if after is not None:
                    arcs.append(("K", more, after))
                arcs.append(("R", RENAME + more, NEEDED[state][1]))
            by_state.append(arcs)
        _arcs[key] = (by_state, min(cost for arcs in by_state for _, cost, _ in arcs))
    return _arcs[key]


class Lattice:
    """The lattice of ``rows`` (initial, fault) with a price of leaving it in each state.

    ``leave``: by state the cost from the lattice's end on, None where the end
    can't be left. In a ``last`` lattice turns can also be inserted behind the
    last row; elsewhere that is done in front of the first row of the next one.
    """

    def __init__(self, rows, leave, last):
        self.steps = [row_arcs(*row) for row in rows]
        self.leave, self.last, self.n = leave, last, len(rows)
        end = self.n * STATES
        # The least that the rows to come can cost is a price that holds everywhere.
        low = min(x for x in leave if x is not None)
        self.price = [low] * (end + STATES)
        for i in range(self.n - 1, -1, -1):
            low += self.steps[i][1]
            self.price[i * STATES : (i + 1) * STATES] = [low] * STATES
        self.arcs = [None] * (end + STATES)
        self._mark_open()

    def _out(self, node):
        """Arcs out of a node to nodes that reach the end: (label, cost, node), -1 for the end; labels in order."""
        i, state = divmod(node, STATES)
        out = []
        if i < self.n:
            base = node - state + STATES
            out = [(label, cost, base + after) for label, cost, after in self.steps[i][0][state]]
        elif self.leave[state] is not None:
            out.append(("", self.leave[state], -1))
        if i < self.n or self.last:
            out.append(("I", INSERT, node - state + NEEDED[state][1]))
        out.sort()
        return out

    def _mark_open(self):
        """Prices of nodes that can't reach the end are set aside."""
        if all(x is not None for x in self.leave):
            return
        ahead = [x is not None for x in self.leave]
        for i in range(self.n, -1, -1):
            here = ahead if i == self.n else [
                any(ahead[after] for _, _, after in self.steps[i][0][state]) for state in range(STATES)
            ]
            here = list(here)
            if i < self.n or self.last:
                for _ in range(2):
                    here = [here[s] or here[NEEDED[s][1]] for s in range(STATES)]
            for state in range(STATES):
                if not here[state]:
                    self.price[i * STATES + state] = NEVER
            ahead = here

    def solve(self, state=0):
        """The cost of the cheapest way from the first node in ``state`` to the end, None if there is none."""
        price, arcs = self.price, self.arcs
        if price[state] >= NEVER:
            return None
        path = [state]
        while True:
            node = path[-1]
            own = arcs[node]
            if own is None:
                own = arcs[node] = self._out(node)
            least, to = NEVER, -1
            for _, cost, after in own:
                value = cost if after < 0 else cost + price[after]
                if value < least:
                    least, to = value, after
            if price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            elif to < 0:
                return price[state]
            else:
                path.append(to)

    def trace(self, state=0):
        """The labels of the cheapest way whose labels come first, with the state in front of each; and the state
        at the end. To be asked for after ``solve``."""
        price, arcs = self.price, self.arcs
        dead, path, tried = set(), [state], [0]
        labels = []
        while True:
            node = path[-1]
            own = arcs[node]
            if own is None:
                own = arcs[node] = self._out(node)
            at = tried[-1]
            if at == len(own):
                dead.add(node)
                path.pop()
                tried.pop()
                labels.pop()
                continue
            tried[-1] += 1
            label, cost, after = own[at]
            if after < 0:
                if price[node] == cost:
                    return labels, node % STATES
            elif price[node] == cost + price[after] and after not in dead:
                labels.append((label, node % STATES))
                path.append(after)
                tried.append(0)


def distances(rows, last):
    """Costs of the rows from each state in front to each state behind them, row by row; ``NEVER`` for no way."""
    out = [NEVER] * (STATES * STATES)
    for behind in range(STATES):
        leave = [0 if s == behind else None for s in range(STATES)]
        lattice = Lattice(rows, leave, last)
        for front in range(STATES):
            cost = lattice.solve(front)
            if cost is not None:
                out[front * STATES + behind] = cost
    return out
