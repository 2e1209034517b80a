"""Property graphs held as DataFrames.

A graph has one DataFrame per vertex label (``id`` + typed property columns)
and edge parts (``src``, ``dst`` + typed property columns). Inside, ids are the
tables' native keys beside their vertex label; the public id text (such as
``customer-17``) is made by the label's ``IdText`` rule only in results. A
literal public id is translated once into a native key, so ``src IN (...)`` and
``id IN (...)`` reach the Parquet scan. Labels without a rule hold public ids. Vertices added later
with ids that their label's rule does not make (a UUID, say) lie in a second table of the label, which
holds public ids; edges between native keys cannot reach it, all others can.

Traversals become joins: ``out(label)`` is edge-join-vertex, ``where`` is a left
semi join, ``drop`` is a left anti join. Which side is broadcast is left to the
optimizer's size threshold and to adaptive execution; building a query starts
no job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IdText:
    """Public id of a whole-number key: ``prefix`` + the number, zero-padded to ``width``."""

    prefix: str
    width: int = 0

    def text(self, key: Column) -> Column:
        if self.width:
            return F.format_string(f"{self.prefix}%0{self.width}d", key.cast("bigint"))
        return F.concat(F.lit(self.prefix), key.cast("string"))

    def key(self, text: str) -> int | None:
        """The native key of a public id, or None when the id belongs to another label."""
        digits = text.removeprefix(self.prefix)
        if not text.startswith(self.prefix) or not re.fullmatch(r"-?[0-9]+", digits):
            return None
        return int(digits) if f"{int(digits):0{self.width}d}" == digits else None

    def key_column(self, text: Column) -> Column:
        number = F.when(text.startswith(self.prefix), F.substring(text, F.lit(len(self.prefix) + 1), F.length(text)).try_cast("bigint"))
        return F.when(self.text(number) == text, number)


@dataclass(frozen=True)
class EdgePart:
    """Edges of one label, or of several in a column ``label``. ``src_label`` and ``dst_label`` name
    the vertex labels of the ends, whose keys ``src`` and ``dst`` hold; None: public ids of any label.
    ``dst_values``: properties of the far end that follow from ``dst`` alone, where every ``dst`` has its
    vertex; filters on them need no join."""

    frame: DataFrame
    labels: tuple[str, ...]
    labelled: bool = False
    src_label: str | None = None
    dst_label: str | None = None
    dst_values: dict[str, Column] | None = None

    def of(self, labels: Iterable[str]) -> "EdgePart | None":
        """The part's edges with one of ``labels``."""
        kept = tuple(l for l in self.labels if l in set(labels))
        if not kept or not self.labelled:
            return self if kept else None
        return replace(self, labels=kept, frame=self.frame.where(F.col("label").isin(list(kept))))

    def label_column(self) -> Column:
        return F.col("label") if self.labelled else F.lit(self.labels[0])

    def counts(self) -> DataFrame:
        n = F.count(F.lit(1)).alias("n")
        if self.labelled:
            return self.frame.groupBy("label").agg(n)
        return self.frame.agg(n).select(F.lit(self.labels[0]).alias("label"), "n")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _label(table) -> str:
    """The label of a vertex table: its name, or the first half of the name of the public ids' table."""
    return table[0] if isinstance(table, tuple) else table


def _properties(frame: DataFrame, besides: Sequence[str]) -> list[str]:
    return [c for c in frame.columns if c not in besides]


class PropertyGraph:
    """``vertices``: label -> DataFrame with ``id``. ``edges``: label -> DataFrame with public ids in
    ``src`` and ``dst``; ``parts``: further edge parts. ``ids``: label -> public id rule."""

    def __init__(self, vertices: dict[str, DataFrame], edges: dict[str, DataFrame] | None = None,
                 parts: Sequence[EdgePart] = (), ids: dict[str, IdText] | None = None):
        self.vertices = dict(vertices)
        self.parts = [EdgePart(e, (l,)) for l, e in (edges or {}).items()] + list(parts)
        self.ids = dict(ids or {})

    def _with(self, vertices=None, parts=None) -> "PropertyGraph":
        return PropertyGraph(self.vertices if vertices is None else vertices, None,
                             self.parts if parts is None else parts, self.ids)

    def edge_labels(self) -> list[str]:
        return list(dict.fromkeys(l for p in self.parts for l in p.labels))

    def _parts(self, labels: Iterable[str]) -> list[EdgePart]:
        return [q for p in self.parts if (q := p.of(labels)) is not None]

    # --- public ids ---------------------------------------------------------------
    def _text(self, label: str | None, key: Column) -> Column:
        return self.ids[label].text(key) if label in self.ids else key

    def _key_column(self, label: str | None, text: Column) -> Column:
        return self.ids[label].key_column(text) if label in self.ids else text

    def _keys(self, label: str | None, texts: Sequence[str]) -> list:
        if label not in self.ids:
            return list(texts)
        return [k for t in texts if (k := self.ids[label].key(t)) is not None]

    # --- scans (S8, G1, G2) -----------------------------------------------------
    def _public(self, label: str, frame: DataFrame) -> DataFrame:
        return frame.select(self._text(label, F.col("id")).alias("id"),
                            *_properties(frame, ("id",)), F.lit(_label(label)).alias("label"))

    def V(self, labels: Iterable[str] | None = None) -> DataFrame:
        wanted = None if labels is None else set(labels)
        return _union([self._public(t, v) for t, v in self.vertices.items() if wanted is None or _label(t) in wanted])

    def _public_edges(self, p: EdgePart) -> DataFrame:
        return p.frame.select(self._text(p.src_label, F.col("src")).alias("src"),
                              self._text(p.dst_label, F.col("dst")).alias("dst"),
                              *_properties(p.frame, ("src", "dst", "label")), p.label_column().alias("label"))

    def E(self, labels: Iterable[str] | None = None) -> DataFrame:
        return _union([self._public_edges(p) for p in (self.parts if labels is None else self._parts(labels))])

    def edge_table(self, label: str) -> DataFrame:
        return self.E([label]).drop("label")

    def vertex_count(self) -> DataFrame:
        """G1: one count per label table, summed (each count is a partial aggregate)."""
        return _union([v.agg(F.count(F.lit(1)).alias("n")) for v in self.vertices.values()]) \
            .agg(F.sum("n").cast("bigint").alias("n_vertices"))

    def edge_count(self) -> DataFrame:
        return _union([p.counts() for p in self.parts]).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_edges"))

    def counts_by_label(self) -> DataFrame:
        vertices = [v.agg(F.count(F.lit(1)).alias("n")).select(F.lit("vertex").alias("kind"), F.lit(_label(l)).alias("label"), "n")
                    for l, v in self.vertices.items()]
        edges = [p.counts().select(F.lit("edge").alias("kind"), "label", "n") for p in self.parts]
        return _union(vertices + edges).groupBy("kind", "label").agg(F.sum("n").alias("n"))

    # --- predicates (P11-P14) ------------------------------------------------------
    def _labels_with(self, key: str, label: str | None = None) -> list[str]:
        return [label] if label else [_label(t) for t, v in self.vertices.items() if key in v.columns]

    def has(self, key: str, value, label: str | None = None) -> DataFrame:
        """``has([label,] key, value)``: a missing property is null, so such vertices drop."""
        return self.V(self._labels_with(key, label)).where(F.col(key) == F.lit(value))

    def has_within(self, key: str, values: Sequence, label: str | None = None) -> DataFrame:
        return self.V(self._labels_with(key, label)).where(F.col(key).isin(list(values)))

    def vertex_by_id(self, ids: DataFrame | Sequence[str]) -> DataFrame:
        """Lookup by id. Literal ids become a filter on the native key of each label they can
        belong to; a DataFrame of ids (first column) is semi-joined on the native key."""
        if isinstance(ids, DataFrame):
            wanted = ids.select(F.col(ids.columns[0]).alias("_wanted"))
            found = [v.join(wanted.select(self._key_column(l, F.col("_wanted")).alias("_key")), F.col("id") == F.col("_key"), "left_semi")
                     for l, v in self.vertices.items()]
            return _union([self._public(l, f) for l, f in zip(self.vertices, found)])
        keys = {l: self._keys(l, ids) for l in self.vertices}
        found = [self._public(l, v.where(F.col("id").isin(keys[l]))) for l, v in self.vertices.items() if keys[l]]
        return _union(found) if found else self.V().where(F.lit(False))

    # --- property maps (G3, G4) ------------------------------------------------------
    @staticmethod
    def value_map_long(vertices: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id") -> DataFrame:
        """G4 in long form ``(id, key, value)``; absent (null) properties are left out."""
        keys = list(keys) if keys is not None else _properties(vertices, (id_col, "label"))
        stack = "stack({n}, {args}) as (key, value)".format(
            n=len(keys), args=", ".join(f"'{k}', cast(`{k}` as string)" for k in keys))
        return vertices.select(F.col(id_col).alias("id"), F.expr(stack)).where(F.col("value").isNotNull())

    @staticmethod
    def value_map(vertices: DataFrame, keys: Sequence[str] | None = None, id_col: str = "id") -> DataFrame:
        """G4 as ``map<string, array<string>>`` (vertex properties are lists)."""
        keys = list(keys) if keys is not None else _properties(vertices, (id_col, "label"))
        m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                              F.array(*[F.array(F.col(k).cast("string")) for k in keys]))
        return vertices.select(F.col(id_col).alias("id"),
                               F.map_filter(m, lambda k, v: v[0].isNotNull()).alias("properties"))

    def edge_value_map_long(self, labels: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
        """G4 on edges ``(src, dst, label, key, value)``: one value per key, absent ones left out."""
        edges = self.E(labels)
        keys = list(keys) if keys is not None else _properties(edges, ("src", "dst", "label"))
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
        return (edges.select("src", "dst", "label", F.inline(pairs)).where(F.col("value").isNotNull()))

    def edge_value_map(self, labels: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
        """G4 on edges as ``map<string, string>``: edge properties are single values."""
        edges = self.E(labels)
        keys = list(keys) if keys is not None else _properties(edges, ("src", "dst", "label"))
        m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("string") for k in keys]))
        return edges.select("src", "dst", "label", F.map_filter(m, lambda k, v: v.isNotNull()).alias("properties"))

    def sample(self, n: int = 3) -> DataFrame:
        """``limit(n)`` made repeatable by ordering on id (top-n per task, then merged)."""
        return self.V().orderBy("id").limit(n)

    # --- traversals (G5-G10, J1, J2, U1) ------------------------------------------------
    def _leaving(self, part: EdgePart, centres, centre_col: str) -> DataFrame | None:
        """(center_id, edge_label, dst) of the part's edges that leave the centres. Literal ids become
        ``src IN (...)`` on the native key; a DataFrame of ids is joined on the key."""
        edges = part.frame.select("src", "dst", part.label_column().alias("edge_label"))
        if isinstance(centres, (list, tuple)):
            keys = self._keys(part.src_label, centres)
            if not keys:
                return None
            edges = edges.where(F.col("src").isin(keys))
        else:
            ids = centres.select(F.col(centre_col).alias("_center")).distinct()
            keyed = ids.select(self._key_column(part.src_label, F.col("_center")).alias("_key"))
            edges = edges.join(keyed, F.col("src") == F.col("_key"))
        return edges.select(self._text(part.src_label, F.col("src")).alias("center_id"), "edge_label", "dst")

    def _ends(self, part: EdgePart, key: str | None = None, labels: Iterable[str] | None = None) -> dict[str | None, DataFrame]:
        """Vertex tables that the part's far ends can lie in, by label, with ids as ``dst`` holds them.
        A part whose ends are public ids gets the one public table (label None)."""
        wanted = None if labels is None else set(labels)
        allowed = [t for t, v in self.vertices.items() if (wanted is None or _label(t) in wanted) and (key is None or key in v.columns)]
        if part.dst_label is not None:
            return {part.dst_label: self.vertices[part.dst_label]} if part.dst_label in allowed else {}
        return {None: _union([self._public(t, self.vertices[t]) for t in allowed])} if allowed else {}

    def _check_property(self, key: str) -> None:
        if not self._labels_with(key):
            raise ValueError(f"no vertex label has property {key!r}")

    def out(self, start, labels: Sequence[str], start_col: str = "id",
            to_labels: Sequence[str] | None = None) -> DataFrame:
        """Rows ``(start id, edge label, neighbour vertex ...)``: one per edge (bag
        semantics). ``to_labels`` limits the vertex tables searched for the far end."""
        found = []
        for part in self._parts(labels):
            hop = self._leaving(part, start, start_col)
            for label, targets in ({} if hop is None else self._ends(part, labels=to_labels)).items():
                public = [self._text(label, F.col("id")).alias("id"), *_properties(targets, ("id", "label")),
                          (F.col("label") if label is None else F.lit(label)).alias("label")]
                found.append(hop.join(targets, F.col("dst") == F.col("id"))
                             .select(F.col("center_id").alias("start_id"), "edge_label", *public))
        if not found:
            raise ValueError(f"no edges of {list(labels)} reach a vertex table")
        return _union(found)

    def out_values(self, start, label: str, keys: Sequence[str], to_labels: Sequence[str] | None = None) -> DataFrame:
        """``out(label).values(k1, k2)``: one row per value."""
        reached = self.out(start, [label], to_labels=to_labels)
        return self.value_map_long(reached, keys).select(F.col("key").alias("prop_key"),
                                                         F.col("value").alias("prop_value"))

    def _found(self, centres, labels, bound_key, bound, centre_col) -> list[tuple[str | None, DataFrame]]:
        """Per vertex label of the neighbours: (center_id, key) with the bound met, one row per edge."""
        self._check_property(bound_key)
        out = []
        for part in self._parts(labels):
            hop = self._leaving(part, centres, centre_col)
            if hop is not None and bound_key in (part.dst_values or {}):
                out.append((part.dst_label, hop.where(part.dst_values[bound_key] >= F.lit(bound)).select("center_id", F.col("dst").alias("key"))))
                continue
            for label, targets in ({} if hop is None else self._ends(part, bound_key)).items():
                met = targets.where(F.col(bound_key) >= F.lit(bound)).select(F.col("id").alias("key"))
                out.append((label, hop.join(met, F.col("dst") == F.col("key")).select("center_id", "key")))
        return out

    def _named(self, found: list[tuple[str | None, DataFrame]], spark) -> DataFrame:
        if not found:
            return spark.createDataFrame([], "center_id string, neighbour_id string")
        return _union([f.select("center_id", self._text(l, F.col("key")).alias("neighbour_id")) for l, f in found])

    def neighbours(self, centres, labels: Sequence[str], bound_key: str, bound,
                   where_label: str | None = None, where_key: str | None = None, where_bound=None,
                   centre_col: str = "id") -> DataFrame:
        """G6-G8 in single-join form: ``out(l1..lk).has(bound_key, gte(bound))``
        with one scan per edge part (labels in one part share it, which equals the
        union as they are disjoint and share the bound), then optionally keep
        neighbours that have an ``out(where_label)`` vertex with ``where_key >=
        where_bound`` (left semi join on the neighbour). Duplicates from
        multi-edges stay. ``centres`` is a list of ids or a DataFrame with ``centre_col``."""
        found = self._found(centres, labels, bound_key, bound, centre_col)
        if where_label is not None:
            found = [(l, self._semi(l, f, where_label, where_key, where_bound)) for l, f in found]
        return self._named(found, next(iter(self.vertices.values())).sparkSession)

    def _semi(self, label: str | None, found: DataFrame, where_label: str, where_key: str, where_bound) -> DataFrame:
        self._check_property(where_key)
        good = []
        for part in self._parts([where_label]):
            if label is not None and part.src_label is not None and part.src_label != label:
                continue
            # keys on both sides native where the labels are known to agree, public otherwise
            native = part.src_label == label
            source = F.col("src") if native else self._text(part.src_label, F.col("src"))
            for targets in self._ends(part, where_key).values():
                met = targets.where(F.col(where_key) >= F.lit(where_bound)).select(F.col("id").alias("_end"))
                edges = part.frame.select(source.alias("_src"), "dst")
                good.append((native, edges.join(met, F.col("dst") == F.col("_end"), "left_semi").select("_src")))
        if not good:
            return found.where(F.lit(False))
        if all(native for native, _ in good):
            return found.join(_union([g for _, g in good]), F.col("key") == F.col("_src"), "left_semi")
        public = [g if not native else g.select(self._text(label, F.col("_src")).alias("_src")) for native, g in good]
        return found.join(_union(public), self._text(label, F.col("key")) == F.col("_src"), "left_semi")

    def neighbours_union(self, centres, labels: Sequence[str], bound_key: str, bound,
                         centre_col: str = "id") -> DataFrame:
        """The literal form, one branch per label, bag union."""
        return _union([self.neighbours(centres, [l], bound_key, bound, centre_col=centre_col) for l in labels])

    def neighbour_counts(self, centres: DataFrame, labels: Sequence[str], bound_key: str, bound,
                         centre_col: str = "id", **where) -> DataFrame:
        """Result count for every centre at once; centres without results count 0."""
        ids = centres.select(F.col(centre_col).alias("center_id")).distinct()
        found = self.neighbours(ids, labels, bound_key, bound, centre_col="center_id", **where)
        counts = found.groupBy("center_id").agg(F.count(F.lit(1)).alias("result_count"))
        return (ids.join(counts, "center_id", "left")
                .select("center_id", F.coalesce("result_count", F.lit(0)).cast("bigint").alias("result_count")))

    def edges_where_source(self, label: str, key: str, values: Sequence) -> DataFrame:
        """``E().hasLabel(label).where(outV().has(key, within(values)))``."""
        kept = []
        for part in self._parts([label]):
            gone = self._matching(part.src_label, key, values)
            frame = part.frame.where(F.lit(False)) if gone is None else part.frame.join(gone, F.col("src") == F.col("_id"), "left_semi")
            kept.append(self._public_edges(replace(part, frame=frame)))
        return _union(kept).drop("label")

    # --- writes (G11-G14, J3) -----------------------------------------------------------
    def _matching(self, label: str | None, key: str, values: Sequence) -> DataFrame | None:
        """Ids (``_id``, as an edge end of that label holds them) of the vertices with ``key`` in
        ``values``; None where the label does not have the property."""
        if label is None:
            return self.has_within(key, values).select(F.col("id").alias("_id")) if self._labels_with(key) else None
        table = self.vertices.get(label)
        if table is None or key not in table.columns:
            return None
        return table.where(F.col(key).isin(list(values))).select(F.col("id").alias("_id"))

    def add_vertices(self, label: str, rows: DataFrame) -> "PropertyGraph":
        """Append rows (no uniqueness check; a rerun appends again). ``rows`` has public ids, of any
        form: those that the label's rule does not make are kept as they are. A null id is an error."""
        named = F.when(F.col("id").isNull(), F.raise_error(F.lit("a vertex has no id"))).otherwise(F.col("id"))
        rest = _properties(rows, ("id",))
        rows = rows.select(named.alias("id"), *rest)
        pieces = {label: rows}
        if label in self.ids:
            keyed = rows.select(self.ids[label].key_column(F.col("id")).alias("_key"), "id", *rest)
            pieces = {label: keyed.where("_key IS NOT NULL").select(F.col("_key").alias("id"), *rest),
                      (label, "public"): keyed.where("_key IS NULL").select("id", *rest)}
        new = dict(self.vertices)
        for table, piece in pieces.items():
            new[table] = new[table].unionByName(piece, allowMissingColumns=True) if table in new else piece
        return self._with(vertices=new)

    def add_edges(self, label: str, sources: DataFrame, target: DataFrame, properties: dict | None = None) -> "PropertyGraph":
        """An edge from every source vertex to the *first* target vertex
        (smallest id, so reruns pick the same one). The target is a scalar
        subquery, so no join is planned; no target means no edges. The new edges
        are one more part of the label; what the label already holds stays where it is."""
        first = target.select(F.min("id")).scalar()
        props = [F.lit(v).alias(k) for k, v in (properties or {}).items()]
        edges = (sources.select(F.col("id").alias("src"), first.alias("dst"))
                 .where(F.col("dst").isNotNull()).select("src", "dst", *props))
        return self._with(parts=[*self.parts, EdgePart(edges, (label,))])

    def drop_edges_where_source(self, key: str, values: Sequence, labels: Sequence[str] | None = None) -> "PropertyGraph":
        """``E()[.hasLabel(labels)].where(outV().has(key, within(values))).drop()``. Edges whose
        source label lacks the property are not touched."""
        chosen = set(self.edge_labels() if labels is None else labels)
        new = []
        for part in self.parts:
            gone = self._matching(part.src_label, key, values)
            if gone is None or not chosen & set(part.labels):
                new.append(part)
                continue
            source = F.col("src")
            if part.labelled and not chosen >= set(part.labels):
                # edges of other labels have no key to match and stay, in the same pass
                source = F.when(F.col("label").isin(sorted(chosen)), F.col("src"))
            new.append(replace(part, frame=part.frame.join(gone, source == F.col("_id"), "left_anti")))
        return self._with(parts=new)

    def drop_vertices(self, key: str, values: Sequence) -> "PropertyGraph":
        """Drop matching vertices and every edge incident to them. Vertex tables are filtered,
        and an edge is looked up only among the labels its ends can have."""
        kept = ~F.coalesce(F.col(key).isin(list(values)), F.lit(False))
        vertices = {l: (v.where(kept) if key in v.columns else v) for l, v in self.vertices.items()}
        parts = []
        for part in self.parts:
            frame = part.frame
            for end, label in (("src", part.src_label), ("dst", part.dst_label)):
                gone = self._matching(label, key, values)
                if gone is not None:
                    frame = frame.join(gone, F.col(end) == F.col("_id"), "left_anti")
            parts.append(replace(part, frame=frame))
        return self._with(vertices=vertices, parts=parts)
