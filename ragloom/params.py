"""Parameter sets. Defaults are the reference's configured values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkParams:
    """Fixed-window / recursive chunking, measured in characters (code points)."""

    size: int = 500
    overlap: int = 50
    min_chars: int = 10

    def __post_init__(self):
        if self.size <= 0:
            raise ValueError(f"chunk size must be positive, got {self.size}")
        if self.overlap < 0:
            raise ValueError(f"chunk overlap must be >= 0, got {self.overlap}")
        if self.overlap >= self.size:
            # the step size - overlap would be <= 0 and the window loop would never end
            raise ValueError(f"overlap ({self.overlap}) must be smaller than size ({self.size})")

    @property
    def step(self) -> int:
        return self.size - self.overlap


@dataclass(frozen=True)
class SearchParams:
    """Top-k cosine search. ``min_score`` is the context threshold (inclusive)."""

    k: int = 5
    min_score: float = 0.5
    # hashed-token embedding width used by the offline embedder
    dim: int = 256
    # largest query matrix (bytes) shipped to every task in one broadcast;
    # bigger query tables are searched block by block
    max_broadcast_bytes: int = 64 << 20

    def __post_init__(self):
        if self.k <= 0:
            raise ValueError(f"k must be positive, got {self.k}")
        if self.dim <= 0:
            raise ValueError(f"dim must be positive, got {self.dim}")


@dataclass(frozen=True)
class PackParams:
    """Context packing budget: UTF-8 bytes (each chunk + one newline) and a chunk cap."""

    max_bytes: int = 2000
    max_chunks: int = 10

    def __post_init__(self):
        if self.max_bytes < 0 or self.max_chunks < 0:
            raise ValueError(f"budget must be non-negative, got {self.max_bytes} bytes, {self.max_chunks} chunks")


# configured RAG path: threshold 0.5, k=5, 2000 bytes, 10 chunks
CONFIGURED_PACK = PackParams(2000, 10)
# second preset (graph constants): 4000 bytes, 10 chunks
GRAPH_PACK = PackParams(4000, 10)
# service default k when none is given
DEFAULT_SERVICE_K = 10
