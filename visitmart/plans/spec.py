"""Declarative extracts: a dict names the filters, tables and fields that are wanted.

An element is a key, or a key with its parameters: ``"facts"``, ``{"date": "Month"}`` (one main parameter) or
``{"date": {"resolution": "Month", "inline": True}}``. Keys and parameter names match without regard to case.
Errors name the element's path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions.keys import KeyFactory, hash_key
from visitmart.functions.scalar import default_for, discretize, partition_start, static
from visitmart.functions.sequence import sequence_string
from visitmart.model import DIMENSION, EVENT, FACT, KEY, LABEL, PAGE, VISIT, Field, StarSchema
from visitmart.operators import filters as flt
from visitmart.operators import splits
from visitmart.operators.aggregate import count_fact, label_field, visit_facts
from visitmart.operators.scopes import Scope, funnel_rows, items_of, pairs, to_copies, to_events, to_pages, to_parts, with_index
from visitmart.plans.extract import Context, FieldMaker, TableDef, date_fields, extract_tables, fill_dates, fill_times, time_fields
from visitmart.sources.shared import written_once
from visitmart.sources.visits import normalise


class SpecError(ValueError):
    """Something is wrong with an element of the description."""


@dataclass(frozen=True)
class Element:
    """A key with its parameters, and where it stands."""

    key: str
    params: dict[str, Any]
    path: str

    @staticmethod
    def of(value: Any, path: str, main: dict[str, str]) -> Element:
        if isinstance(value, str):
            return Element(value.lower(), {}, f"{path}/{value}")
        if not isinstance(value, dict) or len(value) != 1:
            raise SpecError(f"{path}: expected a key, or a key with its parameters, not {value!r}")
        key, given = next(iter(value.items()))
        if not isinstance(given, dict):
            given = {main.get(key.lower(), "value"): given}
        return Element(key.lower(), {k.lower(): v for k, v in given.items()}, f"{path}/{key}")

    def get(self, name: str, default: Any = None) -> Any:
        return self.params.get(name.lower(), default)

    def need(self, name: str) -> Any:
        if name.lower() not in self.params:
            raise SpecError(f"{self.path}: {name} is missing")
        return self.params[name.lower()]


#: The parameter that stands for itself where a key has just a value.
MAIN = {
    "visit": "select", "page": "select", "event": "select", "current": "name", "static": "value", "partitionkey": "days", "sequence": "items",
    "mvtest": "id", "count": "scope", "facts": "types", "xafacts": "types", "dimension": "fields", "xa": "dimension", "date": "resolution",
    "time": "resolution", "index": "scope", "discretize": "select", "contactid": "name", "split": "by", "custom": "value",
    "daterange": "start", "sample": "percentage", "limit": "count", "rule": "rule", "pageevent": "eventid",
    "repeat": "count", "matrix": "items", "funnel": "steps", "pages": "fields", "events": "fields", "goals": "fields", "tables": "tables",
}

FieldFactory = Callable[[Element, "Parser"], FieldMaker]
TableFactory = Callable[[Element, "Parser"], list[TableDef]]
FilterFactory = Callable[[Element, "Parser"], flt.Filter]
FIELDS: dict[str, FieldFactory] = {}
TABLES: dict[str, TableFactory] = {}
FILTERS: dict[str, FilterFactory] = {}
#: Splitters of one's own: from a scope to parts of the visit's pages by name.
SPLITTERS: dict[str, Callable[[Scope], dict[str, Column]]] = {}


def register(kind: dict[str, Any], key: str) -> Callable:
    """Makes a factory known under a key; own factories come in by the same door as these."""

    def add(factory):
        kind[key.lower()] = factory
        return factory

    return add


def custom_field(key: str, make: Callable[[Scope], Column], role: str = DIMENSION) -> None:
    """A field computed by a function of the scope, usable as ``key`` or ``{key: {"name": ...}}``."""
    register(FIELDS, key)(lambda e, p: lambda ctx, s: (s, [Field(e.get("name", key), role, make(s))]))


def custom_expander(key: str, expand: Callable[[Scope], Scope]) -> None:
    """A level of one's own: a function from a scope to a finer one."""
    register(TABLES, key)(lambda e, p: [p.table(e, lambda ctx, s: [("", expand(s))])])


def custom_splitter(key: str, split: Callable[[Scope], dict[str, Column]]) -> None:
    """Parts of a visit by a function of the scope, usable as ``{"split": {"by": key, ...}}``."""
    register(SPLITTERS, key)(split)


def custom_filter(key: str, condition: Callable[[Element], Column]) -> None:
    """A filter by a boolean column."""
    register(FILTERS, key)(lambda e, p: flt.where(condition(e)))


@dataclass
class Parser:
    #: dimension functions by name, see :data:`XA`
    dimensions: dict[str, Any] = field(default_factory=dict)

    def field_list(self, values: Any, path: str) -> list[FieldMaker]:
        if isinstance(values, (str, dict)):
            values = [values]
        return [self.field(v, f"{path}[{i}]") for i, v in enumerate(values or [])]

    def field(self, value: Any, path: str) -> FieldMaker:
        e = Element.of(value, path, MAIN)
        if e.key not in FIELDS:
            raise SpecError(f"{e.path}: there is no such field; there are {sorted(FIELDS)}")
        make = FIELDS[e.key](e, self)
        prefix, postfix = e.get("prefix", ""), e.get("postfix", "")
        extra = {k: e.get(k) for k in ("friendly", "sort", "hide", "kind") if e.get(k) is not None}

        def affixed(ctx: Context, scope: Scope) -> tuple[Scope, list[Field]]:
            try:
                scope, fields = make(ctx, scope)
            except (SpecError, KeyError, TypeError, AttributeError) as wrong:
                raise SpecError(f"{e.path}: {wrong}") from wrong
            out = [replace(f, **extra).affix(prefix, postfix) if prefix or postfix or extra else f for f in fields]
            return scope, [replace(f, lookup=old.lookup) for f, old in zip(out, fields, strict=True)]

        return affixed

    def tables(self, values: Any, path: str) -> list[TableDef]:
        if isinstance(values, (str, dict)):
            values = [values]
        out: list[TableDef] = []
        for i, v in enumerate(values or []):
            at = f"{path}[{i}]"
            if isinstance(v, dict) and {k.lower() for k in v} & {"name", "fields", "merge"} and not (len(v) == 1 and next(iter(v)).lower() in TABLES):
                e = Element("table", {k.lower(): x for k, x in v.items()}, at)
                out.append(self.table(e, _parts_of(e)))
                continue
            e = Element.of(v, at, MAIN)
            if e.key not in TABLES:
                raise SpecError(f"{e.path}: there is no such table; there are {sorted(TABLES)}")
            out += TABLES[e.key](e, self)
        return out

    def table(self, e: Element, expand, name: str | None = None) -> TableDef:
        """A definition; ``merge`` adds the fields and child tables of further ones."""
        parts = [e, *[Element("merge", {k.lower(): x for k, x in m.items()}, f"{e.path}/merge") for m in e.get("merge") or []]]
        fields = [f for p in parts for f in self.field_list(p.get("fields"), f"{p.path}/fields")]
        tables = [t for p in parts for t in self.tables(p.get("tables"), f"{p.path}/tables")]
        return TableDef(e.get("name", name or e.key.capitalize()), fields, expand, tables)

    def filters(self, values: Any, path: str) -> list[flt.Filter]:
        out = []
        for i, v in enumerate(values or []):
            e = Element.of(v, f"{path}[{i}]", MAIN)
            if e.key not in FILTERS:
                raise SpecError(f"{e.path}: there is no such filter; there are {sorted(FILTERS)}")
            out.append(FILTERS[e.key](e, self))
        return out

    def conditions(self, values: Any, path: str) -> Callable[[Scope | None], list[splits.Condition]]:
        """Conditions on pages, for a scope: a page or event without an id is the one in scope."""
        parts = []
        for v in [values] if isinstance(values, dict) else values:
            key, target = next(iter(v.items()))
            if isinstance(target, dict):
                target = next(iter(target.values()), None)
            make = {"page": splits.page_is, "pageevent": splits.page_has_event, "mvtest": splits.page_has_test}.get(key.lower())
            if make is None:
                raise SpecError(f"{path}/{key}: a condition is page, pageevent or mvtest")
            parts.append((key.lower(), make, target))

        def of(s: Scope | None) -> list[splits.Condition]:
            out = []
            for key, make, target in parts:
                if target is None:
                    item = None
                    if s is not None and key == "page" and s.page is not None:
                        item = s.page["item_id"]
                    elif s is not None and key == "pageevent" and s.event is not None:
                        item = s.event["definition_id"]
                    if item is None:
                        raise SpecError(f"{path}/{key}: there is no item in scope to compare with; without an id it can't filter")
                    target = item
                out.append(make(target))
            return out

        return of

    def slices(self, e: Element) -> Callable[[Scope], dict[str, Column]]:
        """The named parts of a visit's pages: by conditions, or by a splitter of one's own."""
        by = e.need("by")
        if isinstance(by, str):
            if by.lower() not in SPLITTERS:
                raise SpecError(f"{e.path}/by: there is no splitter {by!r}; there are {sorted(SPLITTERS)}")
            return SPLITTERS[by.lower()]
        conditions = self.conditions(by, e.path)
        before = not bool(e.get("includepage", False)) if e.get("includematchbefore") is None else bool(e.get("includematchbefore"))
        return lambda s: splits.split_pages(s.pages, conditions(s), before, bool(e.get("emptyifconditionnotmet", True)), bool(e.get("total", True)))


def _parts_of(e: Element):
    """A plain table, or one row for each part of a delimited field."""
    path = e.get("expand")
    if not path:
        return lambda ctx, s: [("", s)]

    def expand(ctx: Context, s: Scope):
        value = _select(s, path)
        return [("", to_parts(s, value, e.get("delimiter", "|"), ctx.fresh("part")))]

    return expand


def _select(s: Scope, path: str) -> Column:
    """A dotted path from the item in scope; null where a step is null."""
    if s.item is not None and path in ("", "."):
        return s.item
    head, _, rest = path.partition(".")
    if head in (VISIT, PAGE, EVENT) and rest:
        return _of(s, head, rest)
    return _of(s, s.level, path)


def _of(s: Scope, level: str, path: str) -> Column:
    if level == VISIT:
        return s.visit(path)
    value = s.page if level == PAGE else s.event
    if value is None:
        raise SpecError(f"no {level} in scope")
    for name in path.split("."):
        value = value[name]
    return value


def _role(e: Element, default: str = DIMENSION) -> str:
    role = str(e.get("type", default)).lower()
    if role not in (KEY, DIMENSION, LABEL, FACT):
        raise SpecError(f"{e.path}: unknown type {role!r}")
    return role


def _property(level: str, select: str, name: str) -> FieldFactory:
    def factory(e: Element, p: Parser) -> FieldMaker:
        path = e.get("select", select)

        def make(ctx: Context, s: Scope):
            shown = e.get("name") or (name if path == select else path.split("/")[-1].split(".")[-1].lstrip("@"))
            if "/" in path or "@" in path:
                s, expr = _item_attribute(ctx, s, level, path, e.get("language", "en"))
            else:
                expr = _of(s, level, path)
            default = e.get("default")
            if default == "type":  # what a cell of the type holds when nothing was set
                default = default_for(s.df.select(expr.alias("x")).schema["x"].dataType.simpleString())
            return s, [Field(shown, _role(e), expr, default=default)]

        return make

    return factory


def _item_attribute(ctx: Context, s: Scope, level: str, path: str, language: str) -> tuple[Scope, Column]:
    """``item_id/Field``, ``@displayname`` or ``@templatename`` of the item master."""
    head, _, attribute = path.rpartition("/")
    if "items" not in ctx.sources:
        raise SpecError("an item lookup needs the source 'items'")
    items = ctx.sources["items"].where(F.col("language") == language)
    value = {"@displayname": F.col("display_name"), "@templatename": F.col("template_name")}.get(attribute.lower(), F.col("fields")[attribute])
    key, out = ctx.fresh("item"), ctx.fresh("attribute")
    wanted = items.select(F.col("item_id").cast("string").alias(key), value.alias(out))
    df = s.df.join(wanted, _of(s, level, head or "item_id").cast("string") == F.col(key), "left").drop(key)
    return replace(s, df=df), F.col(out)


register(FIELDS, "visit")(_property(VISIT, "visit_id", "VisitId"))
register(FIELDS, "page")(_property(PAGE, "item_id", "ItemId"))
register(FIELDS, "event")(_property(EVENT, "definition_id", "EventDefinitionId"))


@register(FIELDS, "current")
def _current(e: Element, p: Parser) -> FieldMaker:
    """The item in scope as text."""

    def make(ctx: Context, s: Scope):
        item = s.item if s.item is not None else s.event["definition_id"] if s.level == EVENT else s.page["item_id"] if s.level == PAGE else F.col("visit_id")
        return s, [Field(e.get("name", "Value"), _role(e), item.cast("string"))]

    return make


@register(FIELDS, "static")
def _static(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, [Field(e.get("name", "Static"), _role(e), static(e.need("value")), hide=bool(e.get("hide", False)))])


@register(FIELDS, "discretize")
def _discretize(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, [Field(e.get("name", "Range"), _role(e), discretize(_select(s, e.need("select")), e.need("limits")))])


@register(FIELDS, "contactid")
def _contact(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, [Field(e.get("name", "ContactId"), _role(e), F.col("contact_id"), kind="ContactId")])


@register(FIELDS, "partitionkey")
def _partition(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, [Field(e.get("name", "Partition"), _role(e), partition_start(F.col("save_ts"), int(e.get("days", 0))), kind="Partition", hide=True)])


@register(FIELDS, "sequence")
def _sequence(e: Element, p: Parser) -> FieldMaker:
    """``items``: pages, events or goals; ``field``: what of each; ``type``: path, set or countset."""
    what = str(e.get("items", "pages")).lower()
    default = "item_id" if what == "pages" else "definition_id"

    def make(ctx: Context, s: Scope):
        values = items_of(s, what, lambda x: _of(x, x.level, e.get("field", default)).cast("string"))
        return s, [Field(e.get("name", "Sequence"), DIMENSION, sequence_string(values, e.get("type", "path")))]

    return make


@register(FIELDS, "mvtest")
def _mvtest(e: Element, p: Parser) -> FieldMaker:
    """The combination on the first page that carries the test: a value and a label for each variable."""

    def make(ctx: Context, s: Scope):
        test, n, out = str(e.need("id")), int(e.get("variables", 2)), []
        first = F.try_element_at(F.filter(s.pages, splits.page_has_test(test)), F.lit(1))
        for i in range(n):
            name = f"{e.get('name', 'Var')}{i + 1}"
            out.append(Field(name, DIMENSION, F.get(first["mv_test"]["combination"], F.lit(i))))
            if "test_variables" in ctx.sources:
                known = ctx.sources["test_variables"].where((F.col("test_id") == test) & (F.col("variable") == i)).select("value", "label")
                out.append(label_field(f"{name}Name", name, known, None))
        return s, out

    return make


@register(FIELDS, "count")
def _count(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, [count_fact(s, abs(int(e.get("scope", 0))), e.get("name", "Count"))])


@register(FIELDS, "index")
def _index(e: Element, p: Parser) -> FieldMaker:
    def make(ctx: Context, s: Scope):
        s, index = with_index(s, abs(int(e.get("scope", 1))), ctx.fresh("index"))
        return s, [Field(e.get("name", "Index"), _role(e), index)]

    return make


def _types(e: Element) -> list[str] | None:
    types = e.get("types")
    return [types] if isinstance(types, str) else types


@register(FIELDS, "facts")
def _facts(e: Element, p: Parser) -> FieldMaker:
    return lambda ctx, s: (s, visit_facts(s, _types(e), bool(e.get("entirevisit", False))))


@register(FIELDS, "xafacts")
def _xafacts(e: Element, p: Parser) -> FieldMaker:
    """Metrics of the dimension row in scope, else of the visit."""

    def make(ctx: Context, s: Scope):
        if s.item is None:
            return s, visit_facts(replace(s, level=VISIT, chain=(VISIT,)) if s.chain == (VISIT,) else s, _types(e), s.chain != (VISIT,))
        wanted = {t.lower() for t in _types(e)} if _types(e) else None
        return s, [Field(n, FACT, s.item["metrics"][n], kind=n) for n in METRICS if wanted is None or n.lower() in wanted]

    return make


@register(FIELDS, "deferred")
def _deferred(e: Element, p: Parser) -> FieldMaker:
    """``ratio``: two columns of the finished row, divided; null where the second is 0."""
    part, whole = e.need("ratio")
    return lambda ctx, s: (s, [Field(e.get("name", "Ratio"), LABEL, F.lit(None), deferred=lambda df: F.try_divide(F.col(f"`{part}`").cast("double"), F.col(f"`{whole}`").cast("double")))])


@register(FIELDS, "fact")
def _fact(e: Element, p: Parser) -> FieldMaker:
    """A number to sum; ``once``: "visit" or "page" adds it once for each of these in a row."""
    return lambda ctx, s: (s, [Field(e.get("name", "Value"), FACT, _select(s, e.need("select")), once=e.get("once"))])


@register(FIELDS, "dimension")
def _dimension(e: Element, p: Parser) -> FieldMaker:
    """A table of its own with a reference to it; ``inline``: its fields right here. Prefixed where asked for."""
    makers = p.field_list(e.need("fields"), f"{e.path}/fields")
    name, key, prefix = e.get("name", "Dimension"), bool(e.get("key", False)), e.get("fieldprefix", "")

    def make(ctx: Context, s: Scope):
        s, fields = ctx.fields(s, makers)
        if e.get("inline", False):
            return s, [replace(f, role=DIMENSION if f.role == KEY and not key else f.role).affix(prefix) for f in fields]
        return s, ctx.lookup(s, name, fields, key, prefix)

    return make


def _timed(e: Element, s: Scope, default: str) -> Column:
    path = e.get("select")
    if path:
        return _select(s, path)
    if s.level == EVENT:
        return s.event["ts"]
    return s.page["ts"] if s.level == PAGE else F.col("start_ts")


@register(FIELDS, "date")
def _date(e: Element, p: Parser) -> FieldMaker:
    """``resolution``: Year, Quarter, Month or Date; ``datekey``: numbers as keys; ``inline``: no table."""
    level = str(e.get("resolution", "date")).lower()
    number = bool(e.get("datekey", e.get("usedatekey", False)))
    name, key = e.get("name", "Date"), bool(e.get("key", False))

    def make(ctx: Context, s: Scope):
        fields = date_fields(_timed(e, s, "start_ts"), level, number, ctx.quarter_mode, f"{name}Id")
        if e.get("inline", False):
            first, *rest = fields
            return s, [replace(first, name=name + "Key" if name == "Date" else name, role=KEY if key else DIMENSION), *[f.affix("" if name == "Date" else name) for f in rest]]
        return s, ctx.lookup(s, name, fields, key, e.get("fieldprefix", ""), fill_dates(level, number, ctx.quarter_mode))

    return make


@register(FIELDS, "time")
def _time(e: Element, p: Parser) -> FieldMaker:
    resolution, name = str(e.get("resolution", "hour")).lower(), e.get("name", "Time")

    def make(ctx: Context, s: Scope):
        fields = time_fields(_timed(e, s, "start_ts"), resolution, f"{name}Id")
        if e.get("inline", False):
            first, *rest = fields
            return s, [replace(first, name=name, role=KEY if e.get("key") else DIMENSION), *[f.affix(name) for f in rest]]
        return s, ctx.lookup(s, name, fields, bool(e.get("key", False)), e.get("fieldprefix", ""), fill_times(resolution))

    return make


METRICS = ("Visits", "Value", "Bounces", "Conversions", "TimeOnSite", "PageViews", "Count")


def _metrics(s: Scope, **given: Column) -> Column:
    whole = {f.name: f.expr for f in visit_facts(replace(s, level=VISIT, chain=(VISIT,), page=None, event=None))}
    return F.struct(*[(given.get(n) if n in given else whole[n]).cast("long").alias(n) for n in METRICS])


def _by(values: Callable[[Scope], Column], pick: Callable[[Scope, Column], dict[str, Column]]):
    """A dimension function: one (key, metrics) for each distinct value of a visit."""

    def function(s: Scope) -> Column:
        keys = F.array_distinct(F.filter(values(s), lambda k: k.isNotNull()))
        return F.transform(keys, lambda k: F.struct(k.cast("string").alias("key"), _metrics(s, **pick(s, k)).alias("metrics")))

    return function


def _page_metrics(name: str):
    def pick(s: Scope, k: Column) -> dict[str, Column]:
        own = F.filter(s.pages, lambda p: p[name] == k)
        part = replace(s, pages=own)
        facts = {f.name: f.expr for f in visit_facts(replace(part, level=VISIT, chain=(VISIT,), page=None, event=None), ["Value", "Conversions", "TimeOnSite", "PageViews"])}
        return facts

    return pick


def _goal_metrics(s: Scope, k: Column) -> dict[str, Column]:
    own = F.filter(s.events_of_visit(), lambda e: e["is_goal"] & (e["definition_id"] == k))
    return {"Value": F.aggregate(own, F.lit(0).cast("long"), lambda a, e: a + F.coalesce(e["value"], F.lit(0)).cast("long")), "Conversions": F.size(own)}


#: Dimension functions: from a visit to an array of (key, metrics). A row's metrics are those of its pages or
#: goals; what a page or goal has no value of its own for is the visit's.
XA: dict[str, Callable[[Scope], Column]] = {
    "by page": _by(lambda s: F.transform(s.pages, lambda p: p["item_id"]), _page_metrics("item_id")),
    "by page url": _by(lambda s: F.transform(s.pages, lambda p: p["url_path"]), _page_metrics("url_path")),
    "by goal": _by(lambda s: F.transform(F.filter(s.events_of_visit(), lambda e: e["is_goal"]), lambda e: e["definition_id"]), _goal_metrics),
    "by country": _by(lambda s: F.array(F.col("geo.country")), lambda s, k: {}),
    "by region": _by(lambda s: F.array(F.col("geo.region")), lambda s, k: {}),
}


def _xa(e: Element, p: Parser) -> Callable[[Scope], Column]:
    name = str(e.need("dimension")).lower()
    function = p.dimensions.get(name) or XA.get(name)
    if function is None:
        raise SpecError(f"{e.path}: there is no dimension {name!r}; there are {sorted(XA | p.dimensions)}")
    return function


@register(FIELDS, "xa")
def _xa_field(e: Element, p: Parser) -> FieldMaker:
    """The first key that a dimension function gives for the visit, with its label."""
    function = _xa(e, p)

    def make(ctx: Context, s: Scope):
        name = e.get("name", "Key")
        out = [Field(name, _role(e), F.get(function(s), F.lit(0))["key"])]
        source = str(e.need("dimension")).lower()
        if source in ctx.sources:
            out.append(label_field(f"{name}Label", name, ctx.sources[source], "Unknown ({key})"))
        return s, out

    return make


@register(FIELDS, "split")
def _split_field(e: Element, p: Parser) -> FieldMaker:
    slices = p.slices(e)
    makers = p.field_list(e.need("fields"), f"{e.path}/fields")

    def make(ctx: Context, s: Scope):
        out: list[Field] = []
        for name, pages in slices(s).items():
            part, fields = ctx.fields(s.slice(pages), makers)
            s = replace(s, df=part.df)
            out += [replace(f.affix("", name), lookup=f.lookup) for f in fields]
        return s, out

    return make


def level(key: str, expand: Callable[[Scope], Scope], name: str) -> None:
    register(TABLES, key)(lambda e, p: [p.table(e, lambda ctx, s: [("", expand(s))], name)])


level("pages", to_pages, "Pages")
level("events", to_events, "Events")
level("goals", lambda s: to_events(s, goals=True), "Goals")


@register(TABLES, "tables")
def _tables(e: Element, p: Parser) -> list[TableDef]:
    return p.tables(e.need("tables"), e.path)


@register(TABLES, "table")
def _table(e: Element, p: Parser) -> list[TableDef]:
    return [p.table(e, _parts_of(e))]


@register(TABLES, "repeat")
def _repeat(e: Element, p: Parser) -> list[TableDef]:
    def expand(ctx: Context, s: Scope):
        return [("", to_copies(s, int(e.get("count", 1)), "repeat"))]

    made = p.table(e, expand, "Repeat")
    made.fields.insert(0, lambda ctx, s: (s, [Field("Repeat", DIMENSION, F.col("repeat"))]))
    return [made]


@register(TABLES, "matrix")
def _matrix(e: Element, p: Parser) -> list[TableDef]:
    """``items``: pages, events or goals; ``type``: CoOccurrence or Links; ``fields`` of either side, named with 1 and 2."""
    what, links = str(e.get("items", "pages")).lower(), str(e.get("type", "CoOccurrence")).lower() == "links"
    default = [{"page": "item_id"}] if what == "pages" else [{"event": "definition_id"}]
    makers = p.field_list(e.get("fields", default), f"{e.path}/fields")
    names: list[Field] = []

    def expand(ctx: Context, s: Scope):
        def values(x: Scope) -> Column:
            names[:] = ctx.fields(x, makers)[1]
            return F.struct(*[f.expr.alias(f.name) for f in names])

        items = items_of(s, what, values)
        return [("", replace(s, df=pairs(s, items, links), chain=(*s.chain, "pair")))]

    def fields(ctx: Context, s: Scope):
        sides = [Field(f"{f.name}{n}", DIMENSION, F.col(f"{side}.{f.name}")) for n, side in ((1, "one"), (2, "two")) for f in names]
        return s, [*sides, Field("Count", FACT, F.col("weight"), kind="Count")]

    return [TableDef(e.get("name", "Matrix"), [fields], expand)]


@register(TABLES, "funnel")
def _funnel(e: Element, p: Parser) -> list[TableDef]:
    """``steps``: each an event name or id, a list of them, or ``{"name": ..., "events": [...]}``."""
    steps, titles = [], []
    for i, step in enumerate(e.need("steps")):
        titles.append(step.get("name", f"Step {i + 1}") if isinstance(step, dict) else f"Step {i + 1}")
        events = step["events"] if isinstance(step, dict) else step
        steps.append(events if isinstance(events, list) else [events])

    def expand(ctx: Context, s: Scope):
        return [("", replace(s, df=funnel_rows(s, steps), chain=(*s.chain, "step")))]

    def fields(ctx: Context, s: Scope):
        title = F.element_at(F.array(*map(F.lit, titles)), F.col("step"))
        return s, [
            Field("Step", KEY, F.col("step"), kind="Step"), Field("StepName", LABEL, title, sort_by="Step"),
            Field("Continued", FACT, F.col("continued"), kind="Continued"), Field("Fallout", FACT, F.col("fallout"), kind="Fallout"),
            Field("Potential", FACT, F.col("continued") + F.col("fallout"), kind="Potential"),
        ]

    extra = p.field_list(e.get("fields"), f"{e.path}/fields")
    return [TableDef(e.get("name", "Funnel"), [fields, *extra], expand)]


@register(TABLES, "xa")
def _xa_table(e: Element, p: Parser) -> list[TableDef]:
    """A row for each key of a dimension function: key, label and metrics."""
    function, name = _xa(e, p), e.get("name", str(e.need("dimension")).title().replace(" ", ""))

    def expand(ctx: Context, s: Scope):
        item = ctx.fresh("xa")
        return [("", replace(s, df=s.df.select("*", F.explode(function(s)).alias(item)), chain=(*s.chain, "xa"), item=F.col(item)))]

    def fields(ctx: Context, s: Scope):
        out = [Field("Key", KEY, s.item["key"])]
        source = str(e.need("dimension")).lower()
        if source in ctx.sources:
            out.append(label_field("KeyLabel", "Key", ctx.sources[source]))
        return s, [*out, *FIELDS["xafacts"](e, p)(ctx, s)[1]]

    return [TableDef(name, [fields, *p.field_list(e.get("fields"), f"{e.path}/fields")], expand)]


@register(TABLES, "split")
def _split_table(e: Element, p: Parser) -> list[TableDef]:
    """Each child table once for each part of the visit, named with the part."""
    slices = p.slices(e)
    inner = p.tables(e.need("tables"), f"{e.path}/tables")

    def expand(ctx: Context, s: Scope, each: TableDef):
        return [(f"{n}{extra}", sub) for n, pages in slices(s).items() for extra, sub in each.expand(ctx, _narrowed(s, pages))]

    return [replace(t, expand=lambda ctx, s, t=t: expand(ctx, s, t)) for t in inner]


def _narrowed(s: Scope, pages: Column) -> Scope:
    return replace(s, df=s.df.withColumn("pages", pages), pages=F.col("pages"), sliced=True)


@register(FILTERS, "daterange")
def _f_range(e: Element, p: Parser) -> flt.Filter:
    return flt.date_range(e.get("start"), e.get("end"), e.get("field", "start_ts"))


@register(FILTERS, "sample")
def _f_sample(e: Element, p: Parser) -> flt.Filter:
    return flt.sample(float(e.need("percentage")), float(e.get("offset", 0.0)))


@register(FILTERS, "limit")
def _f_limit(e: Element, p: Parser) -> flt.Filter:
    return flt.limit(int(e.need("count")), int(e.get("skip", 0)))


@register(FILTERS, "rule")
def _f_rule(e: Element, p: Parser) -> flt.Filter:
    return flt.rule(e.need("rule"))


@register(FILTERS, "split")
def _f_split(e: Element, p: Parser) -> flt.Filter:
    return flt.ordered_conditions(p.conditions(e.need("by"), e.path)(None))


def _f_condition(name: str, parameter: str) -> None:
    @register(FILTERS, name)
    def factory(e: Element, p: Parser) -> flt.Filter:
        value = e.get(parameter, e.get("select", e.get("value", e.get("id"))))
        return flt.ordered_conditions(p.conditions([{name: value}], e.path)(None))


_f_condition("page", "pageid")
_f_condition("pageevent", "eventid")
_f_condition("mvtest", "id")


@dataclass
class Job:
    """A parsed description, with no row read yet."""

    filters: list[flt.Filter]
    definitions: list[TableDef]
    #: finishing steps: objects with ``validate(star)``, called before data is read, and ``process(star)``
    finishing: list[Any] = field(default_factory=list)

    def run(self, visits: DataFrame, sources: dict[str, DataFrame] | None = None, key_factory: KeyFactory = hash_key,
            quarter_mode: str = "calendar", cutoff: Any = None, share: bool = False) -> StarSchema:
        """The star schema of the visits, lazily. With a cut-off only visits saved since then are read, and filters
        for trial runs are left out.

        Each table is a plan of its own over the visits. With ``share`` the visits that pass the filters are written
        once, now, to the shared folder, and all tables scan their columns of that: one pass over the source, whatever
        it takes to nest its rows, for a copy of the visits. Without it nothing is read before a table is."""
        context = Context(key_factory, quarter_mode, sources or {})
        kept = flt.incremental(self.filters, cutoff) if cutoff is not None else self.filters
        chosen = flt.apply_all(normalise(visits), kept)
        scope = Scope(written_once(chosen, "visits") if share else chosen)
        star = extract_tables(scope, self.definitions, context)
        for step in self.finishing:
            if hasattr(step, "validate"):
                step.validate(star)
        for step in self.finishing:
            step.process(star)
        return star


def parse(spec: dict[str, Any], dimensions: dict[str, Any] | None = None, finishing: list[Any] | None = None) -> Job:
    parser = Parser({k.lower(): v for k, v in (dimensions or {}).items()})
    lower = {k.lower(): v for k, v in spec.items()}
    source = {k.lower(): v for k, v in (lower.get("source") or {}).items()}
    mapper = {k.lower(): v for k, v in (lower.get("mapper") or {}).items()}
    if "tables" not in mapper:
        raise SpecError("mapper/tables is missing")
    return Job(parser.filters(source.get("filters"), "source/filters"), parser.tables(mapper["tables"], "mapper/tables"), finishing or [])


def extract(visits: DataFrame, spec: dict[str, Any], **settings: Any) -> StarSchema:
    """One description, run over nested visits."""
    own = {k: settings.pop(k) for k in ("dimensions", "finishing") if k in settings}
    return parse(spec, **own).run(visits, **settings)


def default_spec(pages: bool = True, goals: bool = True, events: bool = False, contact: bool = False, resolution: str = "Date") -> dict[str, Any]:
    """The usual star: visits by date and place, with pages, goals and events below on request."""
    fields: list[Any] = [{"date": resolution}, {"dimension": {"name": "Geo", "fields": [{"visit": {"select": "geo.country", "name": "Country"}}, {"visit": {"select": "geo.region", "name": "Region"}}]}}]
    if contact:
        fields.append("contactid")
    tables: list[Any] = []
    if pages:
        tables.append({"pages": {"name": "Pages", "fields": ["page", "facts"]}})
    if goals:
        tables.append({"goals": {"name": "Goals", "fields": [{"event": {"name": "GoalId"}}, "facts"]}})
    if events:
        tables.append({"events": {"name": "Events", "fields": [{"event": {"name": "EventId"}}, "facts"]}})
    return {"mapper": {"tables": [{"name": "Visits", "fields": [*fields, "facts"], "tables": tables}]}}
