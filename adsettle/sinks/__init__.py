"""Results as tables, files, pages and workbooks."""
