"""Reading and writing tables, catalogs and configuration."""
