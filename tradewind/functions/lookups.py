"""The category dictionary and the ways to apply it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Category name in Portuguese, then in English.
CATEGORY_PAIRS = """
utilidades_domesticas home_utilities
perfumaria perfumery
automotivo automotive
pet_shop pet_shop
papelaria stationery
unknown unknown
moveis_decoracao furniture_decor
moveis_escritorio office_furniture
ferramentas_jardim tools_garden
informatica_acessorios computing_accessories
cama_mesa_banho bed_bath_table
brinquedos toys
construcao_ferramentas_construcao construction_tools_construction
telefonia telephony
beleza_saude beauty_health
eletronicos electronics
bebes baby
cool_stuff cool_stuff
relogios_presentes watches_gifts
climatizacao air_conditioning
esporte_lazer sports_leisure
livros_interesse_geral books_general_interest
eletroportateis small_appliances
alimentos food
malas_acessorios luggage_accessories
fashion_underwear_e_moda_praia fashion_underwear_beachwear
artigos_de_natal christmas_articles
fashion_bolsas_e_acessorios fashion_bags_accessories
instrumentos_musicais musical_instruments
construcao_ferramentas_iluminacao construction_tools_lighting
livros_tecnicos technical_books
construcao_ferramentas_jardim construction_tools_garden
eletrodomesticos home_appliances
market_place market_place
agro_industria_e_comercio agribusiness
artigos_de_festas party_supplies
casa_conforto home_comfort
cds_dvds_musicais cds_dvds_music
industria_comercio_e_negocios industry_commerce_business
consoles_games consoles_games
moveis_quarto bedroom_furniture
construcao_ferramentas_seguranca construction_tools_safety
telefonia_fixa landline_phones
bebidas drinks
moveis_cozinha_area_de_servico_jantar_e_jardim kitchen_service_dining_garden_furniture
fashion_calcados fashion_shoes
casa_construcao home_construction
audio audio
eletrodomesticos_2 home_appliances_2
fashion_roupa_masculina fashion_male_clothing
cine_foto cinema_photography
moveis_sala living_room_furniture
artes arts
alimentos_bebidas food_drinks
tablets_impressao_imagem tablets_printing_image
fashion_esporte fashion_sports
portateis_cozinha_e_preparadores_de_alimentos portable_kitchen_food_preparers
la_cuisine la_cuisine
flores flowers
pcs pcs
casa_conforto_2 home_comfort_2
portateis_casa_forno_e_cafe portable_home_oven_coffee
dvds_blu_ray dvds_blu_ray
pc_gamer pc_gamer
construcao_ferramentas_ferramentas construction_tools_tools
fashion_roupa_feminina fashion_female_clothing
moveis_colchao_e_estofado mattress_upholstered_furniture
sinalizacao_e_seguranca signaling_safety
fraldas_higiene diapers_hygiene
livros_importados imported_books
fashion_roupa_infanto_juvenil fashion_children_clothing
musica music
artes_e_artesanato arts_crafts
seguros_e_servicos insurance_services
"""

PT, EN = "product_category_name", "product_category_name_english"


def lookup_frame(spark: SparkSession, pairs) -> DataFrame:
    """(source, target) pairs as a lookup frame the planner knows to be tiny."""
    literals = [F.lit(word) for pair in pairs for word in pair]
    return spark.range(1).select(F.explode(F.create_map(*literals)).alias(PT, EN))


def category_lookup(spark: SparkSession) -> DataFrame:
    return lookup_frame(spark, [line.split() for line in CATEGORY_PAIRS.split("\n") if line])


def reverse(lookup: DataFrame) -> DataFrame:
    """The dictionary read from English to Portuguese."""
    return lookup.select(F.col(EN).alias(PT), F.col(PT).alias(EN))


def translate(df: DataFrame, lookup: DataFrame, src: str, dst: str, default: str | None = "unmapped") -> DataFrame:
    """Add ``dst``, the dictionary entry for ``src``, or ``default`` where there is none."""
    named = lookup.select(F.col(PT).alias(src), F.col(EN).alias(dst))
    joined = df.join(named, src, "left").select(*[df[c] for c in df.columns], named[dst])
    if default is None:
        return joined
    return joined.withColumn(dst, F.coalesce(F.col(dst), F.lit(default)))


def display_category(df: DataFrame, lang: str = "English") -> DataFrame:
    """Add ``display_category`` in English, Portuguese or Both.

    The wide marts know the original name only.
    """
    if "category_name" not in df.columns:
        return df.withColumn("display_category", F.col(PT))
    shown: dict[str, Column] = {
        "English": F.col("category_name"),
        "Portuguese": F.col("category_name_pt"),
        "Both": F.concat("category_name", F.lit(" ("), "category_name_pt", F.lit(")")),
    }
    return df.withColumn("display_category", shown[lang])
