"""Repair of conversation structure by the cheapest edits.

A conversation is sound if its role initials are `(s?(ua)+)?`. Each row is kept
(0), given the role user or assistant that is due (1) or deleted (2, the only
choice for blank and duplicate rows); a user or assistant row without text may
be inserted anywhere (5); a truncated row that stays costs 5 more. `audit` holds
the initials K, R, D, I of the cheapest edits in order, ties go to the least
string.

Method: the states of a conversation are "nothing yet", "after system", "after
user" and "after assistant", and a table over rows and states keeps the
cheapest edits so far. Their strings are never copied: edit prefixes are linked
nodes that share their beginnings (`Audits`), with binary-lifting ancestors and
rolling hashes. A tie is decided by a search for the longest common prefix over
the ancestors' hashes; an equality of hashes is verified symbol by symbol, and
verified nodes are merged, so no stretch is verified twice.

Large conversations: rows are put in order by range partitioning and dealt into
blocks of at most `BLOCK` rows. Each block is solved alone from all four states;
no string of a block is the beginning of another, so the blocks' strings can be
compared by their ranks, and a second table over blocks (the same linked nodes,
ranks for symbols) picks the states between blocks. Only then does every block
write its edits. The second table holds a few numbers a block; `audit` is one
string, which limits a conversation to 2 ** 31 rows. `repaired_sha256` is
defined over the whole repaired text: it is taken as the sorted rows stream
through a task, which holds one batch of them at a time.

Defined cases: a null role or text is one space, in the key of the damage a
null conv_id or turn too; a null conv_id is a conversation of its own; null
turns come first; rows of one turn go by role, then by the first 64 characters
and the SHA-256 of the text; repeated rows are duplicates after the first; a
role that starts with none of s, u, a can be given a role or deleted; no rows
give zeros, an empty audit and the hash of the empty text; other columns are
ignored.
"""

import hashlib

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F, types as T

from ..session import durable

BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STATES = range(4)
# After a state: where a kept row of an initial leads, and where the role that is due leads.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
DUE = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE = {2: "user", 3: "assistant"}
# What makes each state a sound end.
ENDING = {0: "", 1: "II", 2: "I", 3: ""}
CLASSES, FAULTS = "sua-", "kbdt"


def letter(cls, fault):
    """One letter for a row's role class and first fault (k: none, b: blank, d: duplicate, t: truncated)."""
    return chr(65 + 4 * CLASSES.index(cls) + FAULTS.index(fault))


DECODED = {letter(c, f): (c, f) for c in CLASSES for f in FAULTS}


class Audits:
    """Strings of edits as nodes linked to their beginnings; node 0 is the empty string."""

    def __init__(self, modulus=(1 << 61) - 1, base=0x2545F4914F6CDD1D):
        self.modulus, self.base = modulus, base
        self.symbol, self.depth, self.hash, self.same, self.up = [None], [0], [0], [0], [()]

    def add(self, node, symbol):
        """The string of `node` with one more symbol (a number)."""
        ups = [node]
        while len(self.up[ups[-1]]) >= len(ups):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        new = len(self.symbol)
        self.symbol.append(symbol)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + symbol + 1) % self.modulus)
        self.same.append(new)
        self.up.append(tuple(ups) if node else (0,))
        return new

    def ancestor(self, node, depth):
        while self.depth[node] > depth:
            steps = self.depth[node] - depth
            node = self.up[node][steps.bit_length() - 1]
        return node

    def _find(self, node):
        while self.same[node] != node:
            self.same[node] = self.same[self.same[node]]
            node = self.same[node]
        return node

    def _verified(self, a, b):
        """Whether two strings of one length are equal, symbol by symbol; equal ones are merged."""
        met = []
        while self._find(a) != self._find(b):
            if self.symbol[a] != self.symbol[b]:
                return False
            met.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        for x, y in met:
            self.same[self._find(x)] = self._find(y)
        return True

    def _first_difference(self, a, b):
        """The nodes where two strings of one length part, or None."""
        if self.hash[a] == self.hash[b]:
            return None if self._verified(a, b) else self._walked(a, b)
        top_a, top_b = a, b
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]):
                x, y = self.up[a][k], self.up[b][k]
                if self.hash[x] != self.hash[y]:
                    a, b = x, y
        if self._verified(self.up[a][0], self.up[b][0]):
            return a, b
        return self._walked(top_a, top_b)

    def _walked(self, a, b):
        """As above, from end to beginning without hashes."""
        found = None
        while a != b:
            if self.symbol[a] != self.symbol[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a, b):
        depth = min(self.depth[a], self.depth[b])
        parted = self._first_difference(self.ancestor(a, depth), self.ancestor(b, depth))
        if parted is None:
            return self.depth[a] < self.depth[b]
        return self.symbol[parted[0]] < self.symbol[parted[1]]

    def symbols(self, node):
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]


def _offer(table, state, cost, audits, node, symbol):
    """Enter a candidate where it is cheaper, or as cheap and less."""
    held = table.get(state)
    if held is not None and cost > held[0]:
        return False
    new = audits.add(node, symbol)
    if held is None or cost < held[0] or audits.less(new, held[1]):
        table[state] = (cost, new)
        return True
    return False


def solve(codes, start, audits=None):
    """{end state: (cost, edits)} of the rows `codes` after the state `start`; inserts stand before a row."""
    audits = audits or Audits()
    table = {start: (0, 0)}
    for code in codes:
        cls, fault = DECODED[code]
        open_states = list(table)
        while open_states:
            state = open_states.pop(0)
            cost, node = table[state]
            if _offer(table, DUE[state], cost + INSERT, audits, node, 73):
                open_states.append(DUE[state])
        after = {}
        more = TRUNCATED if fault == "t" else 0
        for state, (cost, node) in table.items():
            _offer(after, state, cost + DELETE, audits, node, 68)
            if fault in "kt":
                if (state, cls) in KEPT:
                    _offer(after, KEPT[state, cls], cost + KEEP + more, audits, node, 75)
                _offer(after, DUE[state], cost + REROLE + more, audits, node, 82)
        table = after
    return {state: (cost, "".join(map(chr, audits.symbols(node)))) for state, (cost, node) in table.items()}


class Solved(dict):
    """Solutions of short stretches of rows, which repeat a lot; emptied when it gets large."""

    def solve(self, codes, start):
        if len(codes) > 32:
            return solve(codes, start)
        if (codes, start) not in self:
            if len(self) > 100_000:
                self.clear()
            self[codes, start] = solve(codes, start)
        return self[codes, start]


def best_path(matrices, audits=None):
    """(cost, states between the blocks, ending) of blocks given as {(start, end): (cost, rank of its edits)}."""
    audits = audits or Audits()
    table, back = {0: (0, 0)}, []
    for matrix in matrices:
        after, came = {}, {}
        for (start, end), (cost, rank) in matrix.items():
            if start in table and _offer(after, end, table[start][0] + cost, audits, table[start][1], rank):
                came[end] = start
        back.append(came)
        table = after
    best = None
    for state, (cost, node) in table.items():
        total = cost + INSERT * len(ENDING[state])
        if best is None or total < best[0] or total == best[0] and audits.less(node, best[2]):
            best = total, state, node
    cost, state, _ = best
    path = [state]
    for came in reversed(back):
        path.append(came[path[-1]])
    return cost, path[::-1], ENDING[state]


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of `conv_id:turn` chooses."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    deed = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(F.col("deed") == 1, "").when(
        F.col("deed") == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    copies = F.when(F.col("deed") == 0, 0).when(F.col("deed") == 3, 2).otherwise(1)
    return rows.withColumn("deed", deed).select(
        "conv_id", "turn", F.when(F.col("deed") == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows in order: `pos` rises through every conversation, one by one within a task's rows."""
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    keyed = rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "row": F.monotonically_increasing_id()})
    # Equal rows may part: which of them comes first makes no difference.
    ordered = keyed.orderBy("conv_id", "turn", "role", F.substring("text", 1, 64), "digest", "row")
    return durable(ordered.select(
        "conv_id", "turn", "role", "text", "digest", F.monotonically_increasing_id().alias("pos")))


def _coded(placed: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, fault, letter) of every row, without its text."""
    facts = placed.select(
        "conv_id", "turn", "role", "digest", "pos", F.substring("role", 1, 1).alias("cls"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    firsts = facts.where(~F.col("blank")).groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select(
        "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("k")
    cls = F.when(F.col("cls").isin("s", "u", "a"), F.col("cls")).otherwise("-")
    judged = facts.join(firsts, "pos", "left").select("conv_id", "turn", "pos", fault.alias("fault"), cls.alias("cls"))
    code = F.instr(F.lit(CLASSES), F.col("cls")) * 4 + F.instr(F.lit(FAULTS), F.col("fault")) + 60
    return judged.select("conv_id", "turn", "pos", "fault", F.char(code).alias("letter"))


def _blocks(coded: DataFrame, block) -> DataFrame:
    """(conv_id, block, first, codes): at most `block` rows of a conversation that follow each other."""
    return durable(coded.groupBy("conv_id", F.floor(F.col("pos") / block).alias("block")).agg(
        F.min("pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "letter"))).alias("placed")
    ).select("conv_id", "block", "first", F.array_join("placed.letter", "").alias("codes")))


def _matrices(blocks: DataFrame, conv_type) -> DataFrame:
    """Each block solved from all states: costs and ranks by start and end (-1: no way), and its role classes at the ends."""
    fields = [("costs", "array<long>"), ("ranks", "array<long>"), ("illegal", "long"), ("ends", "string")]
    schema = T.StructType([T.StructField("conv_id", conv_type), T.StructField("block", T.LongType())] + [
        T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])

    def solved(batches):
        known = Solved()
        for batch in batches:
            rows = []
            for codes in batch.column("codes").to_pylist():
                ways = {(s, e): x for s in STATES for e, x in known.solve(codes, s).items()}
                rank = {a: i for i, a in enumerate(sorted({a for _, a in ways.values()}))}
                classes = [DECODED[c][0] for c in codes]
                at = [ways.get((s, e)) for s in STATES for e in STATES]
                rows.append(([-1 if w is None else w[0] for w in at], [-1 if w is None else rank[w[1]] for w in at],
                             sum(_illegal(x, y) for x, y in zip(classes, classes[1:])), classes[0] + classes[-1]))
            lists = pa.list_(pa.int64())
            columns = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"),
                 *(pa.array(list(c), t) for c, t in zip(columns, (lists, lists, pa.int64(), pa.string())))],
                names=["conv_id", "block", *(n for n, _ in fields)])

    return blocks.select("conv_id", "block", "codes").mapInArrow(solved, schema)


def _illegal(x, y):
    return x + y not in ("su", "ua", "au")


def _by_conversation(df: DataFrame, order, start, step, finish, schema) -> DataFrame:
    """Stream the rows of each conversation in order through one task; `finish` gives its rows."""

    def streamed(batches):
        conv, held, names, kind = None, None, [f.name for f in schema.fields], None

        def out(rows):
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind if i == 0 else None) for i, c in enumerate(map(list, columns))], names=names)

        for batch in batches:
            kind = batch.column("conv_id").type
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or row[0] != conv:
                    if held is not None:
                        rows.extend((conv, *r) for r in finish(held))
                    conv, held = row[0], start()
                step(held, row[1:])
            if rows:
                yield out(rows)
        if held is not None:
            yield out([(conv, *r) for r in finish(held)])

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(streamed, schema)


def _paths(matrices: DataFrame, conv_type) -> DataFrame:
    """(conv_id, block, start, end, ending, cost, illegal); the last three in the row of the last block, else empty or 0."""
    schema = T.StructType([T.StructField("conv_id", conv_type)] + [
        T.StructField(n, T.StringType() if n == "ending" else T.LongType())
        for n in ("block", "start", "end", "ending", "cost", "illegal")])

    def step(held, row):
        block, costs, ranks, illegal, ends = row
        held["illegal"] += illegal + (held["last"] is not None and _illegal(held["last"], ends[0]))
        held["last"] = ends[1]
        held["blocks"].append((block, costs, ranks))

    def finish(held):
        ways = ({(i // 4, i % 4): (c, r) for i, (c, r) in enumerate(zip(costs, ranks)) if c >= 0}
                for _, costs, ranks in held["blocks"])
        cost, path, ending = best_path(ways)
        n = len(held["blocks"]) - 1
        for i, (block, _, _) in enumerate(held["blocks"]):
            yield (block, path[i], path[i + 1], *((ending, cost, held["illegal"]) if i == n else ("", 0, 0)))

    return _by_conversation(
        matrices, ["block"], lambda: {"illegal": 0, "last": None, "blocks": []}, step, finish, schema)


def replay(codes, start, edits):
    """(lines inserted before, place, role or None for its own) of every row that stays, and the state at the end.

    Inserts after the last row that stays come with a null place.
    """
    state, before, lines, place = start, [], [], 0
    for edit in edits:
        if edit == "I":
            state = DUE[state]
            before.append(ROLE[state])
            continue
        if edit != "D":
            state = KEPT[state, DECODED[codes[place]][0]] if edit == "K" else DUE[state]
            lines.append((before, place, ROLE[state] if edit == "R" else None))
            before = []
        place += 1
    if before:
        lines.append((before, None, None))
    return lines


def _edited(blocks: DataFrame, paths: DataFrame, conv_type) -> DataFrame:
    """(conv_id, block, audit, lines) of every block along its path."""
    same = blocks["conv_id"].eqNullSafe(paths["conv_id"]) & (blocks["block"] == paths["block"])
    ways = blocks.join(paths, same).select(
        blocks["conv_id"], blocks["block"], "first", "codes", "start", "end", "ending")
    line = T._parse_datatype_string("array<struct<pos:long,kind:int,before:array<string>,role:string>>")
    schema = T.StructType([T.StructField("conv_id", conv_type), T.StructField("block", T.LongType()),
                           T.StructField("audit", T.StringType()), T.StructField("lines", line)])
    arrow = pa.list_(pa.struct([("pos", pa.int64()), ("kind", pa.int32()), ("before", pa.list_(pa.string())),
                                ("role", pa.string())]))

    def edited(batches):
        known = Solved()
        for batch in batches:
            audits, lines = [], []
            for _, _, first, codes, start, end, ending in zip(*(c.to_pylist() for c in batch.columns)):
                edits = known.solve(codes, start)[end][1]
                # Without a row of their own, inserts go behind the last row of the block.
                last = first + len(codes) - 1
                found = [{"pos": last if p is None else first + p, "kind": 2 if p is None else 0, "before": b, "role": r}
                         for b, p, r in replay(codes, start, edits)]
                if ending:
                    roles = [ROLE[2], ROLE[3]][-len(ending):]
                    found.append({"pos": last, "kind": 3, "before": roles, "role": None})
                audits.append(edits + ending)
                lines.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(audits, pa.string()), pa.array(lines, arrow)],
                names=["conv_id", "block", "audit", "lines"])

    return durable(ways.mapInArrow(edited, schema))


def _hashed(placed: DataFrame, edited: DataFrame, conv_type) -> DataFrame:
    """(conv_id, repaired_sha256): rows and their edits stream by in order."""
    edits = edited.select("conv_id", F.inline("lines")).select(
        "conv_id", "pos", "kind", "before", "role", F.lit(None).cast("string").alias("text"))
    texts = placed.select(
        "conv_id", "pos", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("before"), "role", "text")
    schema = T.StructType([T.StructField("conv_id", conv_type), T.StructField("repaired_sha256", T.StringType())])

    def start():
        return {"hash": hashlib.sha256(), "any": False, "pos": None, "role": None}

    def line(held, role, text):
        held["hash"].update((("\n" if held["any"] else "") + role + ":" + text).encode())
        held["any"] = True

    def step(held, row):
        pos, kind, before, role, text = row
        for inserted in before or ():
            line(held, inserted, "")
        if kind == 0:
            held["pos"], held["role"] = pos, role
        elif kind == 1 and held["pos"] == pos:
            line(held, held["role"] or role, text)

    def finish(held):
        yield (held["hash"].hexdigest(),)

    return _by_conversation(edits.unionByName(texts), ["pos", "kind"], start, step, finish, schema)


def repair(rows: DataFrame, ids: DataFrame = None, block=BLOCK) -> DataFrame:
    """One row per conv_id of `rows` and of `ids`: faults, the cheapest edits, their cost and the repaired text's hash."""
    conv_type = rows.schema["conv_id"].dataType
    placed = _placed(rows)
    coded = durable(_coded(placed))
    blocks = _blocks(coded, block)
    paths = durable(_paths(_matrices(blocks, conv_type), conv_type))
    edited = _edited(blocks, paths, conv_type)
    turns = coded.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    faults = coded.groupBy("conv_id").agg(*(
        F.count_if(F.col("fault") == f).alias(n) for f, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))))
    ends = paths.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    audit = edited.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("blocks")).select(
        "conv_id", F.array_join("blocks.audit", "").alias("audit"))
    parts = [turns, faults, ends, audit, _hashed(placed, edited, conv_type)]
    if ids is not None:
        parts.append(ids.select("conv_id").distinct())
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in zeros),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
