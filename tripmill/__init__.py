"""Layered trip analytics as DataFrame operators.

``functions``  column expressions
``sources``    readers and writers of landed and layered tables
``operators``  DataFrame -> DataFrame transformations, free of actions
``plans``      layer runs that write tables and keep step records
``streaming``  incremental landing
"""
