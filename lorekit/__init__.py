"""A Spark engine that distils run logs into a small, ranked pool of lessons."""

from importlib import import_module

__version__ = "0.2.0"
_HOMES = {
    "LessonPipeline": "lorekit.plans.pipeline", "EngineConfig": "lorekit.plans.config", "ModelConfig": "lorekit.plans.config", "Pool": "lorekit.operators.pool", "ChatEndpoint": "lorekit.operators.providers",
    "FixedAnswers": "lorekit.operators.providers", "quality_score": "lorekit.operators.quality", "normalize": "lorekit.operators.normalize", "dedup": "lorekit.operators.cluster",
    "consolidate": "lorekit.operators.cluster", "decide": "lorekit.operators.merge", "apply_operations": "lorekit.operators.merge", "extract": "lorekit.operators.extract", "segments": "lorekit.operators.parse",
}
__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_HOMES[name]), name)
