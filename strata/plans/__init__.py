"""Compositions: the reference models (``marts``) and the query registry run
against the driver's test tables (``registry`` + ``oracle``)."""
