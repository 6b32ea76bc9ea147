"""Operations of a training-data pipeline: deduplication, filtering, mixing, search, encoding."""
