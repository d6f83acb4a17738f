from voltatlas.queries import (  # noqa: F401
    candidates,
    coercions,
    cubes,
    formats,
    layers,
    stations,
    streams,
    tables,
    traffic,
)
from voltatlas.queries.registry import QUERIES, SQL  # noqa: F401
