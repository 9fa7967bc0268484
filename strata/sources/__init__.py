"""Landed payload readers, the table catalogue and sinks."""
