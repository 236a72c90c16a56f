"""Model artefacts (S18/S19): pipeline models saved under the shared model root."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite-save, so a retrained model replaces the previous one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S19."""
    return PipelineModel.load(path)
