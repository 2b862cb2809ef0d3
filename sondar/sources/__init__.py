"""sondar.sources"""
