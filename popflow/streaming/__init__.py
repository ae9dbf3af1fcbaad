from popflow.streaming.pipeline import (  # noqa: F401
    changelog_writer,
    list_pipeline,
    start_views,
)
