"""Settings of the stages; each validates itself."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

# Terms of business names that identify nothing, used on the query side only.  Their order has no meaning.
STOPWORDS = (
    "a", "ag", "an", "and", "associate", "associates", "at", "bar", "bv", "by", "cafe", "co", "company", "consulting", "corp",
    "corporation", "enterprise", "enterprises", "for", "general", "global", "gmbh", "group", "holding", "holdings", "hotel", "hotels",
    "in", "inc", "incorporated", "industries", "industry", "international", "limited", "llc", "llp", "ltd", "market", "mart",
    "national", "nv", "of", "on", "or", "partner", "partners", "plc", "private", "pty", "public", "pvt", "restaurant", "restaurants",
    "sa", "sarl", "service", "services", "shop", "shops", "solution", "solutions", "srl", "store", "stores", "system", "systems",
    "tech", "technologies", "technology", "the", "to", "traders", "trading",
)


class _Settings:
    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict):
        """Unknown keys are ignored, so that older and newer manifests can be read."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known})


@dataclass(frozen=True)
class RetrievalConfig(_Settings):
    """Which routes run, and the bounds on what they return."""

    exact_name: bool = True
    name_token: bool = True
    address: bool = False
    combined: bool = False
    fuzzy_name: bool = False
    max_candidates: int = 32
    max_block: int = 10_000
    df_ratio: float = 0.01
    min_token: int = 2
    split: str = "unspecified"

    def __post_init__(self):
        if self.max_candidates < 1 or self.max_block < 1 or self.min_token < 1 or not 0 < self.df_ratio <= 1:
            raise ValueError("retrieval bounds must be positive, df_ratio in (0, 1]")

    @property
    def routes(self) -> tuple[str, ...]:
        return tuple(r for r in ("exact_name", "name_token", "address", "combined", "fuzzy_name") if getattr(self, r))


@dataclass(frozen=True)
class SamplingConfig(_Settings):
    negatives_per_s1: int = 2
    top_negative_pool: int = 10
    seed: int = 2026

    def __post_init__(self):
        if self.negatives_per_s1 < 1 or self.top_negative_pool < self.negatives_per_s1:
            raise ValueError("negatives must be at least 1 and fit in the pool")


@dataclass(frozen=True)
class TrainConfig(_Settings):
    rounds: int = 40
    depth: int = 3
    learning_rate: float = 0.05
    min_rows: int = 2
    seed: int = 2026
    max_training_pairs: int = 2_000_000

    def __post_init__(self):
        if self.rounds < 1 or self.max_training_pairs < 2:
            raise ValueError("rounds and max_training_pairs are too small")


@dataclass(frozen=True)
class DecisionConfig(_Settings):
    threshold: float = 0.5
    source2_threshold: float | None = None
    source3_threshold: float | None = None

    def of(self, source: int) -> float:
        own = self.source2_threshold if source == 2 else self.source3_threshold
        return self.threshold if own is None else own
