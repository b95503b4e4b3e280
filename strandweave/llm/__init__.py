"""Operations of a training-data pipeline: sharding, deduplication, filters, counts and mixing."""
