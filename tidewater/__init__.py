"""tidewater: message curation as Spark DataFrame operators.

Public API (names follow the operator inventory):

* sources / sinks — :mod:`tidewater.sources.store`, :mod:`tidewater.sources.adapters`
* filters, paging, ordering, dedup, batching — :mod:`tidewater.operators`
* scalars and tokenizers — :mod:`tidewater.functions`
* composite plans — :mod:`tidewater.plans`; streaming — :mod:`tidewater.streaming`
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Task functions (mapInPandas / pandas UDF bodies) are shipped to the Python
# workers by value, so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from tidewater.functions.scalars import (
    base_name,
    batch_file_name,
    default_start,
    format_handle,
    is_iso_time,
    iso_time,
    json_record,
    json_record_length,
    message_from_json,
    message_to_json,
    parse_iso,
    parse_target_list,
    run_name,
    run_stem,
    strip_text,
    token_count_chars,
    token_count_local,
)
from tidewater.functions.tokens import CharTokenizer, LengthTokenizer, LocalTokenizer, PandasTokenizer, Tokenizer
from tidewater.operators.batching import (
    assign_batches,
    batch_items,
    batch_stats,
    drop_oversized,
    oversized_rows,
)
from tidewater.operators.channels import channel_directory
from tidewater.operators.dedup import add_dup_count, prebatch, text_counts
from tidewater.operators.filters import (
    only_channels,
    only_dated_messages,
    since,
    target_channels,
    unknown_targets,
    validate_channels,
    validate_messages,
)
from tidewater.operators.ordering import dense_position, input_position, merge_sorted
from tidewater.operators.paging import cap_per_channel, channel_stops, paged_pull, pull_stats
from tidewater.operators.stats import fetch_stats
from tidewater.plans.curate import (
    batch_runs,
    curate,
    prebatch_runs,
    run_batch,
    run_prebatch,
    survivor_tokens,
    with_tokens,
)
from tidewater.plans.fetch import (
    fetch,
    fetch_state,
    next_watermark,
    requested_channels,
    resolve_window,
    run_fetch,
    to_messages,
)
from tidewater.session import cleanup_scratch, cut_lineage, get_session, shared_dir, stage_table
from tidewater.sources.adapters import read_dialogs, read_raw_messages
from tidewater.sources.store import (
    list_runs,
    load_prompt,
    read_batches,
    read_json_docs,
    read_message_files,
    read_messages,
    read_prompts,
    read_run_by_index,
    read_stops,
    read_watermark,
    render_batches,
    write_batches,
    write_json,
    write_messages,
    write_prebatch,
    write_stops,
    write_watermark,
)
from tidewater.streaming.incremental import run_incremental, streaming_curate, streaming_pull

# the polling pull and its streaming form
incremental_pull = run_fetch
incremental_stream = run_incremental
channels = channel_directory
batch = batch_runs

__all__ = [name for name in dir() if not name.startswith("_")]
