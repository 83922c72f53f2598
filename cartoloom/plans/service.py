"""The query service without its transport: a question in, a GeoJSON collection out, errors as status codes."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from cartoloom.operators import spatial as S
from cartoloom.plans import statements as T
from cartoloom.plans.intent import parse
from cartoloom.sources.geojson import features

#: Features are answered to a map; more than this many are refused, not cut.
MAX_FEATURES = 100_000


class ServiceError(Exception):
    """An error with the status code that a caller gets."""

    def __init__(self, status: int, detail: str):
        super().__init__(detail)
        self.status, self.detail = status, detail


@dataclass(frozen=True)
class QueryRequest:
    """A question in English or French."""

    question: str

    def __post_init__(self) -> None:
        if not isinstance(self.question, str) or not self.question:
            raise ServiceError(422, "question must be a text of at least one character")


@dataclass(frozen=True)
class QueryResponse:
    """The question, the statement as it was run, and its rows as a feature collection."""

    question: str
    sql: str
    geojson: dict = field(default_factory=dict)
    feature_count: int = 0

    def as_dict(self) -> dict:
        return asdict(self)


def health() -> dict:
    return {"status": "ok"}


def collection(rows: DataFrame) -> dict:
    """The rows as a feature collection, every other column a property; at most ``MAX_FEATURES``."""
    import json

    if "geometry" not in rows.columns:
        raise ServiceError(422, "the statement selects no geometry")
    got = features(rows).limit(MAX_FEATURES + 1).collect()
    if len(got) > MAX_FEATURES:
        raise ServiceError(422, f"more than {MAX_FEATURES} features")
    return {"type": "FeatureCollection", "features": [json.loads(r[0]) for r in got]}


def respond(views: dict[str, DataFrame], request: QueryRequest | str, write=None, measure: S.Measure = S.Measure()) -> QueryResponse:
    """Answer a question.  ``write`` turns a question into a statement (by default the intent parser does).

    A writer that fails is a bad gateway (502); a question without an answerable statement, an unsafe one or one that
    fails is unprocessable (422).
    """
    request = QueryRequest(request) if not isinstance(request, QueryRequest) else request
    try:
        if write is not None:
            sql = write(request.question)
        else:
            intent = parse(request.question)
            sql = None if intent is None else T.written(intent)
    except Exception as e:
        raise ServiceError(502, f"no statement could be written: {e}") from e
    if not sql:
        raise ServiceError(422, "no known phrase fits the question")
    try:
        found = collection(T.run_query(views, sql, measure))
    except (T.UnsafeQuery, T.FailedQuery) as e:
        raise ServiceError(422, str(e)) from e
    return QueryResponse(request.question, sql, found, len(found["features"]))
