"""Sources and sinks: landed tables, run store, prompts, watermark."""
