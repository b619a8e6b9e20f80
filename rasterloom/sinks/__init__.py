"""Writers: tables, reports, image files and archives."""
