"""Writers of the lake's tables and of exchange files."""
