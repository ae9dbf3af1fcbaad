from popflow.sources.events import (  # noqa: F401
    decode_events,
    encode_events,
    game_events,
    read_events_stream,
    read_table_file,
    write_events,
)
