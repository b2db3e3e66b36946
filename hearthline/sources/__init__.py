"""Reading and landing: files, documents and spreadsheet grids."""
