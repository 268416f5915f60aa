"""The named datasets and reports of each business area, and their registry."""
