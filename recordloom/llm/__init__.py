"""Operations of a training-data pipeline: filtering, matching, mixing and token output."""
