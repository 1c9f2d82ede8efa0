"""Operations of a pipeline for language-model training data."""
