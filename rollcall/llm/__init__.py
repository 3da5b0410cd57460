"""Operations of a training-data pipeline: one module per operation, ``queries`` for the registry."""
