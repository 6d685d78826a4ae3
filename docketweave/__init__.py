"""docketweave: config-driven entity resolution over nested records, as Spark plans.

extract(cases) gives mentions, resolve(mentions, kind) their groups, emit_triples(spark, dir) the registry's
triples, evaluate(frame) B-cubed of a frame with gold and pred, resolve_stream a registry fed by a file stream.
All return lazy DataFrames.
"""

from docketweave.operators.nested import flatten_json
from docketweave.plans.clustering import resolve
from docketweave.plans.evaluation import b_cubed as evaluate
from docketweave.plans.evaluation import triples as emit_triples
from docketweave.sources.cases import extract_mentions as extract
from docketweave.sources.cases import read_cases
from docketweave.streaming.incremental import resolve_stream

__version__ = "0.1.0"
__all__ = ["emit_triples", "evaluate", "extract", "flatten_json", "read_cases", "resolve", "resolve_stream"]
